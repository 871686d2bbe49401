"""The whole workload on a small set of student files, against plain Python."""

import random

import pytest

from ledgerline.functions import scalars
from ledgerline.plans.workload import Workload, prepare_tables, run


@pytest.fixture(scope="module")
def student_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("students")
    draw = random.Random(7)
    regions = ["Wales", "Scotland", "Ireland"]
    students = range(1, 41)
    info, registration = [], []
    for s in students:
        for presentation in sorted(draw.sample(["2013B", "2013J", "2014B"], draw.randint(1, 2))):
            region = regions[s % 3]
            info.append(f"AAA,{presentation},{s},M,{region},HE,{'' if s % 5 == 0 else '10-20%'},"
                        f"{draw.choice(['0-35', '35-55'])},0,60,N,Pass")
            registration.append(f"AAA,{presentation},{s},{draw.randint(-50, 0)},{draw.choice(['', draw.randint(5, 90)])}")
    events = [(draw.randint(1, 5), draw.choice(students), draw.randint(-5, 100), 0,
               None if draw.random() < 0.1 else float(draw.randint(0, 100))) for _ in range(500)]
    heads = {
        "studentInfo.csv": "code_module,code_presentation,id_student,gender,region,highest_education,imd_band,age_band,"
                           "num_of_prev_attempts,studied_credits,disability,final_result",
        "studentRegistration.csv": "code_module,code_presentation,id_student,date_registration,date_unregistration",
        "assessments.csv": "code_module,code_presentation,id_assessment,assessment_type,date,weight",
        "studentAssessment.csv": "id_assessment,id_student,date_submitted,is_banked,score",
    }
    bodies = {
        "studentInfo.csv": info, "studentRegistration.csv": registration,
        "assessments.csv": [f'"AAA","2013B","{i}","TMA","{"" if i == 5 else 10 * i}","20"' for i in range(1, 6)],
        "studentAssessment.csv": [",".join("" if v is None else str(v) for v in e) for e in events],
    }
    for name, head in heads.items():
        (folder / name).write_text("\n".join([head, *bodies[name]]) + "\n")
    first_end = {}
    for line in sorted(registration, key=lambda r: (int(r.split(",")[2]), r.split(",")[1])):
        _, _, student, _, end = line.split(",")
        first_end.setdefault(int(student), int(end) if end else None)
    return str(folder), events, {s: regions[s % 3] for s in students}, first_end


def test_workload(spark, student_files, tmp_path):
    folder, events, region_of, first_end = student_files
    report = {r.table_name: r for r in prepare_tables(spark, folder, str(tmp_path)).collect()}
    assert report["customers"].output_rows == 40
    assert "age_band" in report["customers"].unstable and "region" in report["customers"].stable
    work = Workload(spark, folder, str(tmp_path))

    row = work.join_report().first()
    assert (row.rows_before, row.delta, row.columns_after) == (500, 0, 15)
    assert len(work.working_set().columns) == 15 and work.working_set().count() == 500

    for r in work.workload().collect():
        scores = [e[4] for e in events if region_of[e[1]] == r.region and e[4] is not None]
        assert (r.txn_count, r.score_total) == (len(scores), sum(scores))
        assert r.score_mean == pytest.approx(sum(scores) / len(scores))
    for r in work.composed().collect():
        scores = [e[4] or 0 for e in events if region_of[e[1]] == r.region]
        assert (r.transactions, r.revenue_total) == (len(scores), sum(scores))

    def mechanism(score, day, end):
        if end is not None and day >= end:
            return scalars.LOST
        if score is None:
            return scalars.PENDING
        return scalars.RESIT if score < 40 else scalars.UPSELL if score >= 80 else scalars.CONTINUATION

    named = [(mechanism(e[4], e[2], first_end[e[1]]), e[4] or 0) for e in events]
    expected = {m: (sum(n == m for n, _ in named), sum(v for n, v in named if n == m)) for m, _ in named}
    assert {r.mechanism: (r.events, r.revenue_proxy) for r in work.mechanisms().collect()} == expected

    candidates = {r.column_name: r for r in work.candidates().collect()}
    assert len(candidates) == 15
    assert candidates["id_student"].source == "assessments,customers,entitlements"
    assert candidates["imd_band"].distinct_count == 1
    wales = [e for e in events if region_of[e[1]] == "Wales"]
    listed = work.transactions(region="Wales", limit=20).collect()
    assert [(r.date_submitted, r.id_student) for r in listed] == sorted((e[2], e[1]) for e in wales)[:20]

    sides = {r.source: r for r in work.reconciliation(str(tmp_path / "none")).collect()}
    assert not sides["batch"].passed  # counts differ by the missing scores
    assert sides["batch"].count_difference == sum(e[4] is None for e in events)
    assert sides["batch"].total_difference == 0 and sides["stream"].passed is None


def test_run_writes_every_result(spark, student_files, tmp_path):
    run(spark, student_files[0], str(tmp_path))
    results = tmp_path / "results"
    assert len(list(results.iterdir())) == 15
    assert spark.read.json(str(results / "validation")).first().passed
    assert spark.read.option("header", True).csv(str(results / "partition_sizes")).count() == 2 + 4 + 8 + 3
    assert not spark.read.json(str(results / "eligibility")).filter("condition = 'volume'").first().met
