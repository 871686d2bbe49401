"""Queries: keyed aggregates under the three null rules, and reports over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import metrics as m
from ledgerline.operators import partitioning as p
from ledgerline.operators.joins import Hop
from ledgerline.plans.registry import query
from ledgerline.plans.tables import (ENTITLEMENTS_SQL, LINES_SQL, STAR_SQL, entitlements, lines, table, to_customer,
                                     to_nation, to_region)


def keyed_sql(key: str, definition: str = m.NON_NULL, source: str = STAR_SQL, metric: str = "score",
              names: tuple[str, str, str] = ("txn_count", "score_total", "score_mean")) -> str:
    """The SQL of a keyed aggregate; totals are summed as decimals so that both sides are exact."""
    value = f"CAST({metric} AS DECIMAL(18, 2))"
    count, mean = f"count({metric})", f"CAST(sum({value}) AS DOUBLE) / nullif(count({metric}), 0)"
    if definition == m.ALL_ROWS:
        count, mean = "count(*)", f"CAST(coalesce(sum({value}), 0) AS DOUBLE) / count(*)"
    elif definition == m.COALESCED:
        mean = f"coalesce({mean}, 0)"
    return f"""SELECT {key}, {count} AS {names[0]}, CAST(coalesce(sum({value}), 0) AS DOUBLE) AS {names[1]},
  {mean} AS {names[2]} FROM {source} GROUP BY {key}"""


SERVICE = ("transactions", "revenue_total", "revenue_mean")


@query("a1_workload_by_region", keyed_sql("r_name"))
def a1_region(spark, root):
    return m.group_metric(lines(spark, root), "r_name", "score", hops=to_region(spark, root), scale=0)


@query("a1_workload_by_nation", keyed_sql("n_name"))
def a1_nation(spark, root):
    return m.group_metric(lines(spark, root), "n_name", "score", hops=to_nation(spark, root), scale=0)


@query("a1_workload_bounded", keyed_sql("n_name"))
def a1_bounded(spark, root):
    return m.group_metric(lines(spark, root), "n_name", "score", hops=to_nation(spark, root), scale=0, partitions=4)


@query("a1_event_workload", keyed_sql("event_type", source="events", metric="value"))
def a1_events(spark, root):
    return m.group_metric(table(spark, root, "events"), "event_type", "value", scale=2)


@query("a2_regional_revenue", keyed_sql("n_name", m.COALESCED, names=SERVICE))
def a2(spark, root):
    return m.regional_revenue(lines(spark, root), "n_name", "score", to_nation(spark, root), scale=0)


# A group that only has missing metrics: the seventh lines.
@query("a2_all_missing_group", keyed_sql("l_linenumber", m.COALESCED, LINES_SQL, names=SERVICE))
def a2_missing(spark, root):
    return m.regional_revenue(lines(spark, root), "l_linenumber", "score", scale=0)


@query("a2_one_region", keyed_sql("r_name", m.COALESCED, f"{STAR_SQL} WHERE r_name = 'ASIA'", names=SERVICE))
def a2_one(spark, root):
    return m.regional_revenue(lines(spark, root), "r_name", "score", to_region(spark, root), region="ASIA", scale=0)


@query("a2_first_regions", keyed_sql("n_name", m.COALESCED, names=SERVICE) + " ORDER BY n_name LIMIT 7")
def a2_first(spark, root):
    return m.regional_revenue(lines(spark, root), "n_name", "score", to_nation(spark, root), limit=7, scale=0)


def composed(spark, root, key="r_name"):
    """The composed service result: every row counts, a missing metric as 0."""
    hops = to_region(spark, root) if key == "r_name" else to_nation(spark, root)
    return m.service_names(m.group_metric(lines(spark, root), key, "score", m.ALL_ROWS, hops, scale=0))


@query("a3_composed_revenue", keyed_sql("n_name", m.ALL_ROWS, names=SERVICE))
def a3(spark, root):
    return composed(spark, root, "n_name")


@query("a4_revenue_report", f"""SELECT string_agg(r_name, ',' ORDER BY r_name) AS regions,
  CAST(sum(transactions) AS BIGINT) AS transaction_total, sum(revenue_total) AS revenue_total
  FROM ({keyed_sql("r_name", m.ALL_ROWS, names=SERVICE)})""")
def a4(spark, root):
    report = m.revenue_report(composed(spark, root), "r_name")
    return report.withColumn("regions", F.array_join("regions", ","))


@query("a5_grand_total", f"""SELECT CAST(sum(txn_count) AS BIGINT) AS txn_count, sum(score_total) AS score_total
  FROM ({keyed_sql("r_name")})""")
def a5(spark, root):
    return m.grand_total(a1_region(spark, root))


@query("a6_transaction_count", "SELECT count(*) AS transactions FROM lineitem")
def a6(spark, root):
    return table(spark, root, "lineitem").agg(F.count(F.lit(1)).alias("transactions"))


@query("a7_distinct_customers", "SELECT count(DISTINCT o_custkey) AS customers FROM orders")
def a7(spark, root):
    return table(spark, root, "orders").agg(F.count_distinct("o_custkey").alias("customers"))


# The names and thresholds of the mechanisms, as the library has them.
MECHANISM_SQL = """CASE WHEN ends IS NOT NULL AND l_shipdate::DATE >= ends THEN 'Revenue at risk / lost'
  WHEN score IS NULL THEN 'Early intervention / outcome pending'
  WHEN score < 40 THEN 'Resit / repeat revenue'
  WHEN score >= 80 THEN 'Revenue secured + upsell next module'
  ELSE 'Revenue secured / continuation revenue' END"""
ENTITLED_SQL = f"""{LINES_SQL} l JOIN orders ON o_orderkey = l_orderkey
  JOIN {ENTITLEMENTS_SQL} e ON e.customer_id = o_custkey"""


def entitled_path(spark, root) -> list[Hop]:
    return [to_customer(spark, root)[0], Hop(entitlements(spark, root), "o_custkey", "customer_id", "entitlements")]


def dated_lines(spark, root):
    return lines(spark, root).withColumn("submitted", F.unix_date(F.col("l_shipdate").cast("date")))


@query("a8_mechanism_breakdown", f"""SELECT {MECHANISM_SQL} AS mechanism, count(*) AS events,
  CAST(coalesce(sum(CAST(score AS DECIMAL(18, 2))), 0) AS DOUBLE) AS revenue_proxy FROM {ENTITLED_SQL} GROUP BY 1""")
def a8(spark, root):
    return m.mechanism_breakdown(dated_lines(spark, root), entitled_path(spark, root), "score", "submitted", "ends", 0)


@query("a9_order_summary", """SELECT count(*) AS events,
  CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18, 2))), 0) AS DOUBLE) AS revenue_total FROM orders""")
def a9(spark, root):
    return m.table_summary(table(spark, root, "orders"), "o_totalprice", scale=2)


def nation_counts(spark, root):
    """(value, n): events per nation, counted along the joins."""
    counted = m.roll_up(lines(spark, root), to_nation(spark, root), ["n_name"], {"n": F.count(F.lit(1))})
    return counted.withColumnRenamed("n_name", "value")


COUNTS_SQL = f"(SELECT n_name AS value, count(*) AS n FROM {STAR_SQL} WHERE n_name IS NOT NULL GROUP BY n_name)"
DISTRIBUTION_SQL = """SELECT count(*) AS distinct_keys, min(n) AS min_count, CAST(floor(median(n)) AS BIGINT)
  AS median_count, max(n) AS max_count, CAST(printf('%.2f', max(n) / min(n)) AS DOUBLE) AS skew_ratio"""


@query("a10_key_distribution", f"{DISTRIBUTION_SQL} FROM {COUNTS_SQL}")
def a10(spark, root):
    return p.key_distribution(nation_counts(spark, root))


@query("a10_customer_distribution",
       f"{DISTRIBUTION_SQL} FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)")
def a10_customers(spark, root):
    return p.key_distribution(p.key_counts(table(spark, root, "orders"), "o_custkey"))


@query("a10_heaviest_lightest", f"""SELECT * FROM (SELECT 'heaviest' AS side, value, n FROM {COUNTS_SQL}
  ORDER BY n DESC, value LIMIT 5) UNION ALL SELECT * FROM (SELECT 'lightest' AS side, value, n FROM {COUNTS_SQL}
  ORDER BY n, value DESC LIMIT 5)""")
def a10_extremes(spark, root):
    return p.extremes(nation_counts(spark, root))


@query("t2_top_groups", f"SELECT * FROM ({keyed_sql('n_name')}) ORDER BY score_total DESC, n_name LIMIT 13")
def t2(spark, root):
    return m.top_groups(a1_nation(spark, root), "n_name", 13)
