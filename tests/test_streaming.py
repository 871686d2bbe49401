"""Streams that go on where they stopped, and give the batch result."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.joins import Hop
from ledgerline.operators.lookups import Cursor, page, pages
from ledgerline.operators.metrics import ALL_ROWS, NON_NULL, group_metric
from ledgerline.session import work_dir
from ledgerline.sources.files import VersionedTable, write_stream
from ledgerline.streaming import totals

SCHEMA = "user_id bigint, score double"


@pytest.fixture
def folder(spark, tmp_path):
    def add(number, rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"part={number}"))

    return str(tmp_path / "in"), add


def as_set(frame):
    return {tuple(r) for r in frame.collect()}


def test_increments_continue_and_equal_batch(spark, folder, tmp_path):
    path, add = folder
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, region string")
    hops = [Hop(users, "user_id", "id", "users")]
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = totals.stream_files(spark, f"{path}/*", SCHEMA)
        totals.increments(stream, hops, "region", "score", target, checkpoint, scale=2)

    add(1, [(1, 1.25), (2, None), (3, 4.0)])
    run()
    add(2, [(1, 2.5), (1, None), (2, 3.0)])
    run()
    run()  # nothing new
    events = spark.read.schema(SCHEMA).parquet(path)
    for definition in (NON_NULL, ALL_ROWS):
        batch = group_metric(events, "region", "score", definition, hops, scale=2)
        assert as_set(totals.totals_of(spark, target, "region", 2, definition)) == as_set(batch)


def test_stateful_totals_continue_and_equal_batch(spark, folder, tmp_path):
    path, add = folder
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = totals.stream_files(spark, f"{path}/*", SCHEMA)
        return totals.stored_totals(stream, "user_id", "score", target, checkpoint, scale=2)

    add(1, [(1, 1.25), (2, None)])
    assert as_set(run()) == {(1, 1, 1.25), (2, 0, 0.0)}
    add(2, [(1, 2.5), (3, 3.0)])
    assert as_set(run()) == {(1, 2, 3.75), (2, 0, 0.0), (3, 1, 3.0)}


def test_totals_before_the_first_batch(spark, tmp_path):
    assert totals.totals_of(spark, str(tmp_path / "none"), "region").count() == 0


def test_stream_of_one_file_and_of_a_folder(spark, data, tmp_path):
    schema = "r_regionkey int, r_name string"
    spark.read.parquet(f"{data}/region.parquet").write.parquet(str(tmp_path / "region.parquet"))
    for number, path in enumerate((f"{data}/region.parquet", str(tmp_path / "region.parquet"))):
        rows = totals.stream_files(spark, path, schema)
        found = totals.stored_totals(rows, "r_name", "r_regionkey", str(tmp_path / f"out{number}"),
                                     str(tmp_path / f"checkpoint{number}"), scale=0)
        assert found.count() == 5


def test_work_folders_lie_below_the_shared_folder(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_snapshots_take_batches_in(spark, folder, tmp_path):
    path, add = folder
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for number in range(1, 7):
        add(number, [(1, number + 0.25), (2, None)])
        totals.increments(totals.stream_files(spark, f"{path}/*", SCHEMA), [], "user_id", "score", target, checkpoint, scale=2, compact_every=2)
        found = as_set(totals.totals_of(spark, target, "user_id", 2))
        assert found == {("1", number, sum(range(1, number + 1)) + 0.25 * number, (sum(range(1, number + 1)) + 0.25 * number) / number), ("2", 0, 0.0, None)}
    store, _ = totals._increment_store(spark, target, "user_id", 2)
    upto, snapshot = store.committed()
    assert upto == 3
    read = {r.f for r in store.rows().select(F.input_file_name().alias("f")).distinct().collect()}
    later = {f for f in read if "/batch=" in f}
    assert {f.split("batch=")[1][0] for f in later} == {"4", "5"} and all(snapshot.split("/")[-1] in f for f in read - later)
    assert "PartitionFilters: [isnotnull(batch" in store.rows()._jdf.queryExecution().executedPlan().toString()


def test_a_snapshot_without_commit_counts_nothing(spark, tmp_path):
    store = totals.BatchStore(spark, str(tmp_path / "out"), "k string, n bigint")
    rows = lambda *r: spark.createDataFrame(r, "k string, n bigint")
    fold = lambda x: x.groupBy("k").agg(F.sum("n").alias("n"), F.max("batch").alias("batch"))
    held = lambda: {(r.k, r.n) for r in fold(store.rows()).collect()}
    assert held() == set() and store.committed() == (-1, None)
    store.write(rows(("a", 1), ("b", 2)), 0)
    store.write(rows(("a", 10)), 1)
    store.snapshot(1, fold)  # the process ends here, before the commit
    assert held() == {("a", 11), ("b", 2)} and store.committed() == (-1, None)
    store.compact(1, fold)
    store.write(rows(("a", 10)), 1)  # a batch that is repeated after its snapshot
    store.write(rows(("b", 5)), 2)
    assert held() == {("a", 11), ("b", 7)} and store.committed()[0] == 1
    store.compact(0, fold)  # older than the snapshot: nothing to do
    store.compact(2, fold)
    assert held() == {("a", 11), ("b", 7)} and store.committed()[0] == 2


def test_events_delivered_twice_count_once(spark, tmp_path):
    schema = "event_id bigint, ts timestamp_ntz, user_id string, score double"
    rows = [(i, f"2024-01-{1 + i % 5:02d} 00:00:00", "u", 1.0) for i in range(20)]
    for number, part in enumerate([rows[:12], rows[:12], rows[8:], rows[8:]]):  # whole files and overlaps
        frame = spark.createDataFrame(part, "event_id bigint, ts string, user_id string, score double").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        frame.coalesce(1).write.parquet(str(tmp_path / "in" / f"part={number}"))
    arrived = totals.stream_files(spark, str(tmp_path / "in" / "*"), schema, files_per_batch=1)
    events = totals.once(arrived, "event_id", "ts", "30 days")
    found = totals.streamed_revenue(events, [], "user_id", "score", 0, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert as_set(found) == {("u", 20, 20.0, 1.0)}


def test_a_restarted_sink_writes_each_row_once(spark, folder, tmp_path):
    path, add = folder
    target, checkpoint = str(tmp_path / "rows"), str(tmp_path / "sink")
    for number in range(1, 4):
        add(number, [(number, None), (number, number / 2)])
        for _ in range(2):
            write_stream(totals.stream_files(spark, f"{path}/*", SCHEMA), target, checkpoint)
        written = spark.read.schema(SCHEMA).json(target).collect()
        assert sorted(map(str, written)) == sorted(str(r) for r in spark.read.schema(SCHEMA).parquet(path).select("user_id", "score").collect())


def test_pages_laid_end_to_end_are_the_whole_order(spark):
    days = [None, 3, 1, 2, 2, None, 1, 1, 1, 3]
    rows = spark.createDataFrame([(d, (i * 7) % 3 or None, "x" if i % 2 else None) for i, d in enumerate(days * 3)], "day int, customer int, note string")
    order = ["day", "customer"]
    whole = [tuple(r) for r in rows.orderBy(*[F.asc_nulls_last(c) for c in ["day", "customer", "note"]]).collect()]
    for size in (1, 4, 7, 30, 31):
        found, sizes, cursor = [], [], None
        for own, cursor in pages(rows, order, size):
            found += [tuple(r) for r in own]
            sizes.append(len(own))
        assert found == whole and sizes[:-1] == [size] * (len(sizes) - 1)
    first, cursor = next(pages(rows, order, 4))
    again = [tuple(r) for own, _ in pages(rows, order, 5, cursor) for r in own]  # another consumer goes on from the cursor
    assert [tuple(r) for r in first] + again == whole
    assert list(pages(rows.limit(0), order, 3)) == []


def test_a_page_is_a_top_selection_of_what_lies_behind(spark, data):
    rows = spark.read.parquet(f"{data}/orders.parquet").select("o_orderdate", "o_custkey", "o_orderkey")
    first = rows.orderBy("o_orderdate").first()
    plan = page(rows, ["o_orderdate", "o_custkey", "o_orderkey"], 10, Cursor(tuple(first), 1))._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_readers_see_the_old_or_the_new_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="nothing was loaded"):
        table.read()
    assert table.replace(spark.range(3)) == 3
    table.store(spark.range(100))  # a load that ends before its commit
    assert table.read().count() == 3 and [r.version for r in table.versions().collect()] == [1]
    before = table.read()
    assert table.replace(spark.range(5).selectExpr("id AS `other name`", "'x' AS note")) == 5
    assert table.read().columns == ["other name", "note"] and table.read().count() == 5
    assert before.count() == 3  # a reader that has begun keeps its version
    assert table.replace(spark.range(0)) == 0 and table.read().count() == 0
