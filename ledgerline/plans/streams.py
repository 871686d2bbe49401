"""Queries: streams of the given tables, each equal to its batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.joins import Hop
from ledgerline.operators.lookups import ordered, page, pages
from ledgerline.operators.metrics import ALL_ROWS, group_metric, service_names
from ledgerline.plans.metrics import SERVICE, keyed_sql
from ledgerline.plans.registry import query
from ledgerline.plans.tables import catalog, lines, score, table, to_region
from ledgerline.session import work_dir
from ledgerline.sources.files import write_stream
from ledgerline.streaming import totals


def stream(spark, root, name):
    tables = catalog(root)
    return totals.stream_files(spark, tables.path_for(name), tables.tables[name].schema)


def streamed_lines(spark, root):
    """Regional totals of the event table, read as a stream."""
    events = stream(spark, root, "lineitem").withColumn("score", score())
    return totals.streamed_revenue(events, to_region(spark, root), "r_name", "score", scale=0)


@query("z1_ordered_stream", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  ORDER BY o_orderdate, o_custkey, o_orderkey""")
def z1(spark, root):
    rows = ordered(table(spark, root, "orders"), ["o_orderdate", "o_custkey", "o_orderkey"])
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("z2_region_stream", keyed_sql("r_name", ALL_ROWS, names=SERVICE))
def z2(spark, root):
    rows = group_metric(lines(spark, root), "r_name", "score", ALL_ROWS, to_region(spark, root), 0)
    return ordered(service_names(rows), ["r_name"])


@query("z3_streamed_regions", keyed_sql("r_name"))
def z3(spark, root):
    return streamed_lines(spark, root)


@query("z3_streamed_event_regions", keyed_sql("r_name", source="""events JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""", metric="value"))
def z3_events(spark, root):
    hops = [Hop(table(spark, root, "customer"), "user_id", "c_custkey", "customer"), *to_region(spark, root)[2:]]
    return totals.streamed_revenue(stream(spark, root, "events"), hops, "r_name", "value", scale=2)


@query("z3_streamed_types", """SELECT event_type, count("value") AS txn_count,
  CAST(coalesce(sum(CAST("value" AS DECIMAL(18, 2))), 0) AS DOUBLE) AS score_total FROM events GROUP BY event_type""")
def z3_types(spark, root):
    return totals.stored_totals(stream(spark, root, "events"), "event_type", "value", work_dir(spark, "totals"),
                                work_dir(spark, "checkpoint"), scale=2)


# Every event is delivered twice, in two files.
@query("z3_redelivered_types", """SELECT event_type, count("value") AS txn_count,
  CAST(coalesce(sum(CAST("value" AS DECIMAL(18, 2))), 0) AS DOUBLE) AS score_total FROM events GROUP BY event_type""")
def z3_redelivered(spark, root):
    inbox = work_dir(spark, "inbox")
    for delivery in (1, 2):
        table(spark, root, "events").coalesce(1).write.parquet(f"{inbox}/delivery={delivery}")
    arrived = totals.stream_files(spark, f"{inbox}/*", catalog(root).tables["events"].schema, files_per_batch=1)
    events = totals.once(arrived, "event_id", "ts", "60 days")
    return totals.streamed_revenue(events, [], "event_type", "value", scale=2).drop("score_mean")


# The second page of the transactions, resumed from the place where the first one ended.
@query("z1_second_page", """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
  ORDER BY o_orderdate, o_custkey, o_orderkey LIMIT 500 OFFSET 500""")
def z1_page(spark, root):
    rows = table(spark, root, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    order = ["o_orderdate", "o_custkey", "o_orderkey"]
    _, cursor = next(pages(rows, order, 500))
    served = F.col("o_orderkey") == cursor.values[2]  # the order is unique here: the row at the cursor
    return page(rows, order, 500, cursor).filter(~served)


@query("io10_row_stream_sink", """SELECT event_id, user_id, event_type, "value" FROM events""")
def io10(spark, root):
    target = work_dir(spark, "rows")
    rows = stream(spark, root, "events").select("event_id", "user_id", "event_type", "value")
    write_stream(rows, target, work_dir(spark, "checkpoint"))
    return spark.read.schema("event_id bigint, user_id bigint, event_type string, value double").json(target)
