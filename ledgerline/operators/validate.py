"""Comparison of results with each other, and reconciliation of totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.joins import Hop, walk
from ledgerline.operators.metrics import NON_NULL, finish, partial_sums
from ledgerline.operators.partitioning import bounded
from ledgerline.operators.profile import orphans, union

TOLERANCE = 1e-6
COUNT, MEASURES = "txn_count", ("score_total", "score_mean")


def join_results(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str] = ("_par", "_base")) -> DataFrame:
    """Two results side by side on their group key, with the groups of only one side kept and marked."""
    a = left.select(F.col(key), *[F.col(c).alias(c + suffixes[0]) for c in left.columns if c != key],
                    F.lit(True).alias("_left"))
    b = right.select(F.col(key).alias("_other"), *[F.col(c).alias(c + suffixes[1]) for c in right.columns if c != key],
                     F.lit(True).alias("_right"))
    joined = a.join(b, F.col(key).eqNullSafe(F.col("_other")), "full_outer")
    side = F.when(F.col("_right").isNull(), "left only").when(F.col("_left").isNull(), "right only").otherwise("both")
    return joined.withColumn(key, F.when(F.col("_left"), F.col(key)).otherwise(F.col("_other"))) \
        .withColumn("side", side).drop("_other", "_left", "_right")


def _gap(name: str) -> Column:
    """|left - right|; a value that only one side has differs without bound."""
    left, right = F.col(f"{name}_par"), F.col(f"{name}_base")
    one_sided = (F.col("side") == "both") & (left.isNull() != right.isNull())
    return F.when(one_sided, F.lit(float("inf"))).otherwise(F.abs(left - right).cast("double"))


def compare_results(parallel: DataFrame, baseline: DataFrame, key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """One row: group counts, groups of one side only, largest difference of each measure, and whether all agree.

    Counts have to be equal, totals and means closer than the tolerance, and no group may be on one side only.
    """
    joined = join_results(parallel, baseline, key)

    def largest(name: str) -> Column:
        return F.coalesce(F.max(_gap(name)), F.lit(0.0))

    report = joined.agg(
        F.count_if(F.col("side") != "right only").alias("parallel_groups"),
        F.count_if(F.col("side") != "left only").alias("baseline_groups"),
        F.count_if(F.col("side") != "both").alias("one_sided_groups"),
        largest(COUNT).alias("max_txn_count_difference"),
        largest("score_total").alias("max_score_total_difference"),
        largest("score_mean").alias("max_score_mean_difference"),
    )
    agree = (F.col("one_sided_groups") == 0) & (F.col("max_txn_count_difference") == 0)
    for name in MEASURES:
        agree = agree & (F.col(f"max_{name}_difference") < tolerance)
    return report.withColumn("passed", agree)


def union_of_keys(results: dict[str, DataFrame], key: str, columns: list[str]) -> DataFrame:
    """All keys of several results with the columns of each (`column_name`); a missing value is 0.

    Rows are tagged, stacked and summed per key, one shuffle for any number of results.
    """
    stacked = union([r.select(key, F.lit(name).alias("_source"), *columns) for name, r in results.items()])
    return stacked.groupBy(key).agg(*[
        F.coalesce(F.sum(F.when(F.col("_source") == name, F.col(c))), F.lit(0)).alias(f"{c}_{name}")
        for name in results for c in columns
    ])


def reconcile(current: DataFrame, others: dict[str, DataFrame], key: str, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per other result: difference to the current one in count, total and worst group; all within tolerance?

    Every result has `key`, `txn_count` and `score_total`. One without rows counts as absent and is not compared.
    """
    marked = {name: r.withColumn("_there", F.lit(1)) for name, r in {"current": current, **others}.items()}
    wide = union_of_keys(marked, key, [COUNT, "score_total", "_there"])
    totals = [F.sum("txn_count_current").alias("count_current"), F.sum("score_total_current").alias("total_current")]
    for i, name in enumerate(others):
        gap = F.abs(F.col("score_total_current") - F.col(f"score_total_{name}"))
        totals += [F.sum(f"txn_count_{name}").alias(f"count_{i}"), F.sum(f"score_total_{name}").alias(f"total_{i}"),
                   F.max(f"_there_{name}").alias(f"there_{i}"), F.max(gap).alias(f"gap_{i}")]
    sides = F.inline(F.array(*[F.struct(
        F.lit(name).alias("source"), F.col("count_current").alias("txn_count_current"), F.col(f"count_{i}").alias("txn_count_other"),
        F.col("total_current").alias("score_total_current"), F.col(f"total_{i}").alias("score_total_other"),
        F.col(f"there_{i}").alias("_there"), F.col(f"gap_{i}").alias("max_group_difference")) for i, name in enumerate(others)]))
    count_gap = F.abs(F.col("txn_count_current") - F.col("txn_count_other"))
    total_gap = F.abs(F.col("score_total_current") - F.col("score_total_other"))
    passed = (count_gap == 0) & (total_gap <= tolerance) & (F.col("max_group_difference") <= tolerance)
    return wide.agg(*totals).select(sides).withColumns({
        "count_difference": count_gap,
        "total_difference": total_gap,
        "passed": F.when(F.col("_there") == 1, passed),
    }).drop("_there")


def join_report(events: DataFrame, hops: list[Hop]) -> DataFrame:
    """One row: event rows before and after the joins, the difference, columns of the result, and orphans per hop.

    Rows after the join are summed from the rows per foreign key, so the wide rows are never built. Orphans are reported
    too, since lost and duplicated rows can cancel out in the difference.
    """
    rows, sums = walk(events, hops, {"_rows": F.count(F.lit(1))}, [])
    after = rows.agg(F.coalesce(sums["_rows"], F.lit(0)).alias("n")).select(F.lit("after").alias("what"), "n")
    before = events.agg(F.count(F.lit(1)).alias("n")).select(F.lit("before").alias("what"), "n")
    lost = []
    for hop in hops:
        child = events if hop.child_key in events.columns else next(
            h.parent for h in hops if hop.child_key in h.parent.columns)
        lost.append(orphans(child, hop, f"orphans_{hop.name}").select(F.col("relation").alias("what"),
                                                                      F.col("orphan_rows").alias("n")))

    def value(name: str) -> Column:
        return F.sum(F.when(F.col("what") == name, F.col("n")))

    width = len(events.columns) + sum(len(h.parent.columns) - (h.child_key == h.parent_key) for h in hops)
    return union([before, after, *lost]).agg(
        value("before").alias("rows_before"), value("after").alias("rows_after"),
        (value("after") - value("before")).alias("delta"),
        F.lit(width).cast("bigint").alias("columns_after"),
        *[value(f"orphans_{h.name}").alias(f"orphans_{h.name}") for h in hops],
    )


def require_lossless(events: DataFrame, hops: list[Hop]) -> None:
    """Raise if the joins change the number of events."""
    row = join_report(events, hops).first()
    if row.delta != 0:
        raise ValueError(f"the join changed the row count: {row.rows_before} -> {row.rows_after}")


def results_by_setting(events: DataFrame, key: str, metric: str, hops: list[Hop], scale: int | None,
                       settings: tuple[int, ...] = (2, 4, 8)) -> DataFrame:
    """The keyed result of every partition setting, setting 0 being the plain aggregation, in one long table.

    Events are joined and summed per key and task once; every setting merges the same partial sums, whose shuffle Spark reuses.
    """
    rows, sums = walk(events, hops, partial_sums(F.col(metric), scale), [key])
    parts = rows.groupBy(key, F.spark_partition_id().alias("_task")).agg(*[total.alias(name) for name, total in sums.items()])
    merge = [F.sum(name).alias(name) for name in sums]
    results = [finish((bounded(parts, n, key) if n else parts).groupBy(key).agg(*merge), key, NON_NULL, scale)
               .withColumn("setting", F.lit(n)) for n in (0, *settings)]
    return union(results)


def same_answer(results: DataFrame, key: str, settings: tuple[int, ...] = (2, 4, 8), tolerance: float = TOLERANCE) -> DataFrame:
    """One row per partition setting: does it give the result of setting 0? See results_by_setting.

    The settings of a key meet in one group; no two results are joined.
    """
    measures = [COUNT, *MEASURES]
    side = lambda n: F.max(F.when(F.col("setting") == n, F.struct(*measures)))
    wide = results.groupBy(key).agg(*[side(n).alias(f"s{n}") for n in (0, *settings)])

    def gap(n: int, name: str) -> Column:
        mine, plain = F.col(f"s{n}.{name}"), F.col(f"s0.{name}")
        one_sided = F.col(f"s{n}").isNotNull() & F.col("s0").isNotNull() & (mine.isNull() != plain.isNull())
        return F.coalesce(F.max(F.when(one_sided, F.lit(float("inf"))).otherwise(F.abs(mine - plain).cast("double"))), F.lit(0.0))

    reports = F.inline(F.array(*[F.struct(
        F.col(f"groups_{n}").alias("parallel_groups"), F.col("groups_0").alias("baseline_groups"), F.col(f"alone_{n}").alias("one_sided_groups"),
        *[F.col(f"{m}_{n}").alias(f"max_{m}_difference") for m in measures], F.lit(n).alias("setting")) for n in settings]))
    totals = [F.count_if(F.col(f"s{n}").isNotNull()).alias(f"groups_{n}") for n in (0, *settings)]
    for n in settings:
        totals.append(F.count_if(F.col(f"s{n}").isNull() != F.col("s0").isNull()).alias(f"alone_{n}"))
        totals += [gap(n, m).alias(f"{m}_{n}") for m in measures]
    report = wide.agg(*totals).select(reports)
    agree = (F.col("one_sided_groups") == 0) & (F.col(f"max_{COUNT}_difference") == 0)
    for name in MEASURES:
        agree = agree & (F.col(f"max_{name}_difference") < tolerance)
    return report.withColumn("passed", agree)


def fingerprints(results: DataFrame, columns: list[str], baseline: int = 0) -> DataFrame:
    """(setting, groups, fingerprint, agrees): results as multisets of rows, compared exactly without joining them.

    A fingerprint is the sum of the hashes of the rows as a decimal: it does not depend on their order and those of parts
    add up. agrees: groups and fingerprint are those of the baseline setting.
    """
    rows = results.select("setting", F.xxhash64(*columns).cast("decimal(38,0)").alias("hash"))
    summed = rows.groupBy("setting").agg(F.count(F.lit(1)).alias("groups"), F.sum("hash").alias("fingerprint"))
    base = F.max(F.when(F.col("setting") == baseline, F.struct("groups", "fingerprint"))).over(W.partitionBy())  # a row a setting
    return summed.select("setting", "groups", "fingerprint", F.struct("groups", "fingerprint").eqNullSafe(base).alias("agrees"))
