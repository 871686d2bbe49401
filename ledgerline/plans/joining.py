"""Queries: joins, lookups and ordered retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import messages
from ledgerline.operators import lookups, validate
from ledgerline.operators.joins import Hop, checked_join, key_violations, lookup_or
from ledgerline.operators.metrics import NON_NULL, ALL_ROWS, group_metric
from ledgerline.plans.metrics import ENTITLED_SQL, MECHANISM_SQL, dated_lines, entitled_path, keyed_sql
from ledgerline.plans.registry import query
from ledgerline.plans.tables import LINES_SQL, STAR_SQL, all_parents, catalog, lines, table, to_nation, to_region

SHOWN = ["l_orderkey", "l_linenumber", "l_extendedprice", "score", "o_custkey", "o_orderstatus", "c_mktsegment",
         "n_name", "r_name", "p_brand", "p_size"]


@query("j1_working_set", f"SELECT {', '.join(SHOWN)} FROM {STAR_SQL} JOIN part ON p_partkey = l_partkey")
def j1(spark, root):
    return checked_join(lines(spark, root), all_parents(spark, root)).select(*SHOWN)


@query("j1_parent_keys", " UNION ALL ".join(
    f"SELECT '{t}' AS parent, '{k}' AS parent_key, count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(0 AS BIGINT) AS null_keys "
    f"FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k})"
    for t, k in [("orders", "o_orderkey"), ("customer", "c_custkey"), ("nation", "n_nationkey"),
                 ("region", "r_regionkey"), ("part", "p_partkey")]))
def j1_keys(spark, root):
    return key_violations(all_parents(spark, root))


WIDTH = 1 + sum(len(catalog("").tables[t].schema.split(", "))
                for t in ["lineitem", "orders", "customer", "nation", "region", "part"])


def join_report_sql(joined: str, orphans: str, width: int) -> str:
    return f"""SELECT (SELECT count(*) FROM lineitem) AS rows_before, (SELECT count(*) FROM {joined}) AS rows_after,
  (SELECT count(*) FROM {joined}) - (SELECT count(*) FROM lineitem) AS delta, CAST({width} AS BIGINT) AS columns_after, {orphans}"""


@query("j2_join_report", join_report_sql(
    f"{STAR_SQL} JOIN part ON p_partkey = l_partkey",
    ", ".join(f"CAST(0 AS BIGINT) AS orphans_{t}" for t in ["orders", "customer", "nation", "region", "part"]), WIDTH))
def j2(spark, root):
    return validate.join_report(lines(spark, root), all_parents(spark, root))


CREDIT_SQL = "(SELECT * FROM customer WHERE c_acctbal >= 0)"


def credit_path(spark, root):
    """Orders and the customers in credit, so that some rows have no parent."""
    orders, customers = to_nation(spark, root)[:2]
    return [orders, Hop(customers.parent.filter("c_acctbal >= 0"), "o_custkey", "c_custkey", "customer")]


@query("j2_lossy_join_report", join_report_sql(
    f"lineitem JOIN orders ON o_orderkey = l_orderkey JOIN {CREDIT_SQL} c ON c_custkey = o_custkey",
    f"""CAST(0 AS BIGINT) AS orphans_orders, (SELECT count(*) FROM orders WHERE NOT EXISTS
    (SELECT 1 FROM {CREDIT_SQL} c WHERE c_custkey = o_custkey)) AS orphans_customer""",
    1 + sum(len(catalog("").tables[t].schema.split(", ")) for t in ["lineitem", "orders", "customer"])))
def j2_lossy(spark, root):
    return validate.join_report(lines(spark, root), credit_path(spark, root))


@query("j3_small_parents", """SELECT s_suppkey, s_acctbal, n_name, r_name FROM supplier
  JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""")
def j3(spark, root):
    parents = to_region(spark, root)[2:]
    parents[0] = Hop(parents[0].parent, "s_nationkey", "n_nationkey", "nation")
    return checked_join(table(spark, root, "supplier"), parents).select("s_suppkey", "s_acctbal", "n_name", "r_name")


TRANSACTION_SQL = f"""SELECT o_orderkey, o_custkey, c_mktsegment, n_name, o_totalprice, o_orderdate::DATE AS ordered
  FROM orders JOIN {CREDIT_SQL} c ON c_custkey = o_custkey LEFT JOIN
  (SELECT * FROM nation WHERE n_regionkey < 3) n ON n_nationkey = c_nationkey"""


@query("j4_inner_and_left", TRANSACTION_SQL.replace("o_orderdate::DATE", "CAST(o_orderdate::DATE AS VARCHAR)"))
def j4(spark, root):
    _, customers = credit_path(spark, root)
    some = table(spark, root, "nation").filter("n_regionkey < 3")
    inner = checked_join(table(spark, root, "orders"), [customers])
    outer = checked_join(inner, [Hop(some, "c_nationkey", "n_nationkey", "nation")], how="left")
    ordered = F.col("o_orderdate").cast("date").cast("string").alias("ordered")
    return outer.select("o_orderkey", "o_custkey", "c_mktsegment", "n_name", "o_totalprice", ordered)


@query("j5_lookup_with_fallback", f"""SELECT o_orderkey, coalesce(c_mktsegment,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END, '') AS segment
  FROM orders LEFT JOIN {CREDIT_SQL} c ON c_custkey = o_custkey""")
def j5(spark, root):
    own = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    found = lookup_or(table(spark, root, "orders"), credit_path(spark, root)[1], "c_mktsegment", [own, F.lit("")],
                      "segment")
    return found.select("o_orderkey", "segment")


ASIA_SQL = f"(SELECT * FROM ({keyed_sql('n_name')}) WHERE n_name > 'F')"
EARLY_SQL = f"(SELECT * FROM ({keyed_sql('n_name', ALL_ROWS)}) WHERE n_name < 'S')"


def two_results(spark, root):
    """Two results under different null rules, each with groups the other lacks."""
    rows, hops = lines(spark, root), to_nation(spark, root)
    strict = group_metric(rows, "n_name", "score", NON_NULL, hops, 0).filter("n_name > 'F'")
    loose = group_metric(rows, "n_name", "score", ALL_ROWS, hops, 0).filter("n_name < 'S'")
    return strict, loose


@query("j6_result_join", f"""SELECT coalesce(a.n_name, b.n_name) AS n_name, a.txn_count AS txn_count_par,
  a.score_total AS score_total_par, a.score_mean AS score_mean_par, b.txn_count AS txn_count_base,
  b.score_total AS score_total_base, b.score_mean AS score_mean_base,
  CASE WHEN b.n_name IS NULL THEN 'left only' WHEN a.n_name IS NULL THEN 'right only' ELSE 'both' END AS side
  FROM {ASIA_SQL} a FULL JOIN {EARLY_SQL} b ON a.n_name = b.n_name""")
def j6(spark, root):
    strict, loose = two_results(spark, root)
    return validate.join_results(strict, loose, "n_name")


@query("j7_union_of_keys", f"""SELECT coalesce(a.n_name, b.n_name) AS n_name,
  coalesce(a.txn_count, 0) AS txn_count_a, coalesce(a.score_total, 0) AS score_total_a,
  coalesce(b.txn_count, 0) AS txn_count_b, coalesce(b.score_total, 0) AS score_total_b,
  coalesce(c.txn_count, 0) AS txn_count_c, coalesce(c.score_total, 0) AS score_total_c
  FROM {ASIA_SQL} a FULL JOIN {EARLY_SQL} b ON a.n_name = b.n_name
  LEFT JOIN ({keyed_sql('n_name')}) c ON c.n_name = coalesce(a.n_name, b.n_name)""")
def j7(spark, root):
    strict, loose = two_results(spark, root)
    third = group_metric(lines(spark, root), "n_name", "score", NON_NULL, to_nation(spark, root), 0)
    return validate.union_of_keys({"a": strict, "b": loose, "c": third}, "n_name", ["txn_count", "score_total"])


@query("j8_entitled_events", f"""SELECT l_orderkey, l_linenumber, score, {MECHANISM_SQL} AS mechanism
  FROM {ENTITLED_SQL}""")
def j8(spark, root):
    return _classified(spark, root)


def _classified(spark, root):
    from ledgerline.functions.scalars import mechanism

    joined = checked_join(dated_lines(spark, root), entitled_path(spark, root), validate=False)
    label = mechanism(F.col("score"), F.col("submitted"), F.col("ends")).alias("mechanism")
    return joined.select("l_orderkey", "l_linenumber", "score", label)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_mktsegment", "status"]


@query("w1_point_lookup", """SELECT c_custkey, c_name, c_mktsegment, 'OK' AS status FROM customer
  WHERE c_custkey = 7""")
def w1(spark, root):
    return lookups.lookup(table(spark, root, "customer"), "c_custkey", 7).select(*CUSTOMER_COLUMNS)


@query("w1_not_found", """SELECT k AS c_custkey, c_name, c_mktsegment, 'NOT_FOUND' AS status
  FROM (SELECT CAST(999999999999 AS BIGINT) AS k) LEFT JOIN customer ON c_custkey = k""")
def w1_missing(spark, root):
    return lookups.lookup(table(spark, root, "customer"), "c_custkey", 999999999999).select(*CUSTOMER_COLUMNS)


@query("w2_batch_lookup", f"""SELECT k AS c_custkey, c_name, c_mktsegment,
  CASE WHEN c_custkey IS NULL THEN 'NOT_FOUND' ELSE 'OK' END AS status
  FROM (SELECT DISTINCT o_custkey AS k FROM orders) LEFT JOIN {CREDIT_SQL} c ON c_custkey = k""")
def w2(spark, root):
    asked = table(spark, root, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.batch_lookup(credit_path(spark, root)[1].parent, "c_custkey", asked).select(*CUSTOMER_COLUMNS)


@query("w2_found", f"""SELECT c_custkey, c_name FROM {CREDIT_SQL} c WHERE c_custkey IN (SELECT user_id FROM events)""")
def w2_found(spark, root):
    asked = table(spark, root, "events").select(F.col("user_id").alias("c_custkey"))
    return lookups.found_rows(credit_path(spark, root)[1].parent, "c_custkey", asked).select("c_custkey", "c_name")


@query("w2_missing", f"""SELECT DISTINCT user_id AS c_custkey FROM events
  WHERE user_id NOT IN (SELECT c_custkey FROM {CREDIT_SQL} c)""")
def w2_missing(spark, root):
    asked = table(spark, root, "events").select(F.col("user_id").alias("c_custkey"))
    return lookups.missing_keys(credit_path(spark, root)[1].parent, "c_custkey", asked)


ORDER = ["o_orderdate", "o_custkey", "o_orderkey"]
LISTED = ["o_orderkey", "o_custkey", "c_mktsegment", "n_name", "o_totalprice"]
LIST_SQL = f"""SELECT {', '.join(LISTED)} FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey"""
ORDER_SQL = "ORDER BY o_orderdate, o_custkey, o_orderkey"


def listed(spark, root, **options):
    _, customers, nations = to_nation(spark, root)
    return lookups.transactions(table(spark, root, "orders"), customers, nations, ORDER,
                                region_column="c_mktsegment", **options).select(*LISTED)


@query("w3_transactions", f"{LIST_SQL} {ORDER_SQL}")
def w3(spark, root):
    return listed(spark, root, region="", limit=0)


@query("w3_of_customer", f"{LIST_SQL} WHERE o_custkey = 37 {ORDER_SQL}")
def w3_customer(spark, root):
    return listed(spark, root, customer_id=37)


@query("w3_of_segment", f"{LIST_SQL} WHERE c_mktsegment = 'MACHINERY' {ORDER_SQL} LIMIT 200")
def w3_segment(spark, root):
    return listed(spark, root, region="MACHINERY", limit=200)


@query("w3_of_customer_and_segment", f"{LIST_SQL} WHERE o_custkey = 37 AND c_mktsegment = (SELECT c_mktsegment FROM customer WHERE c_custkey = 37) {ORDER_SQL}")
def w3_customer_segment(spark, root):
    segment = table(spark, root, "customer").filter("c_custkey = 37").first().c_mktsegment
    return listed(spark, root, customer_id=37, region=segment)


@query("w4_first_keys_batch", f"""SELECT c_custkey, c_name, c_mktsegment, 'OK' AS status FROM customer
  WHERE c_custkey IN (SELECT o_custkey FROM (SELECT * FROM orders {ORDER_SQL} LIMIT 50))""")
def w4(spark, root):
    keys = lookups.first_keys(table(spark, root, "orders"), ORDER, 50, "o_custkey")
    asked = keys.withColumnRenamed("o_custkey", "c_custkey")
    return lookups.batch_lookup(table(spark, root, "customer"), "c_custkey", asked).select(*CUSTOMER_COLUMNS)


def transaction_messages(spark, root):
    """Every event as a Transaction message."""
    rows = checked_join(lines(spark, root), to_region(spark, root), validate=False)
    source = {
        "id_assessment": F.col("l_partkey"), "id_student": F.col("o_custkey"), "assessment_type": F.col("l_returnflag"),
        "region": F.col("r_name"), "score": F.col("score"), "timestamp": F.col("l_shipdate").cast("date").cast("string"),
    }
    return lookups.message_rows(rows, {
        f.name: (source[f.name], f.spark_type) for f in messages.fields_of("Transaction")})


TRANSACTION_MESSAGES_SQL = f"""SELECT l_partkey AS id_assessment, o_custkey AS id_student,
  l_returnflag AS assessment_type, r_name AS region, coalesce(score, 0.0) AS score,
  CAST(l_shipdate::DATE AS VARCHAR) AS "timestamp" FROM {STAR_SQL}"""


@query("w5_transaction_messages", TRANSACTION_MESSAGES_SQL)
def w5(spark, root):
    return transaction_messages(spark, root)


CUSTOMER_MESSAGES_SQL = """SELECT c_custkey AS id_student, '' AS gender, coalesce(n_name, '') AS region,
  coalesce(c_mktsegment, '') AS highest_education, '' AS disability FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey"""


# The tables do not have all fields; the others take their defaults.
@query("w5_customer_messages", CUSTOMER_MESSAGES_SQL)
def customer_messages(spark, root):
    nations = to_nation(spark, root)[2]
    rows = checked_join(table(spark, root, "customer"), [nations], how="left")
    known = {"id_student": F.col("c_custkey"), "region": F.col("n_name"), "highest_education": F.col("c_mktsegment")}
    return lookups.message_rows(rows, {
        f.name: (known.get(f.name, F.lit(None)), f.spark_type) for f in messages.fields_of("Customer")})


ENTITLEMENT_MESSAGES_SQL = """SELECT o_custkey AS id_student,
  CAST(coalesce(datediff('day', DATE '1970-01-01', min(o_orderdate::DATE)), 0) AS DOUBLE) AS date_registration,
  CAST(coalesce(datediff('day', DATE '1970-01-01', max(o_orderdate::DATE) FILTER (WHERE o_orderstatus = 'F'
    AND o_orderpriority = '1-URGENT')), 0) AS DOUBLE) AS date_unregistration FROM orders GROUP BY o_custkey"""


@query("w5_entitlement_messages", ENTITLEMENT_MESSAGES_SQL)
def entitlement_messages(spark, root):
    from ledgerline.plans.tables import entitlements

    return lookups.message_rows(entitlements(spark, root), {
        "id_student": (F.col("customer_id"), "bigint"), "date_registration": (F.col("starts"), "double"),
        "date_unregistration": (F.col("ends"), "double")})


@query("w6_charge_requests", f"""SELECT 'charge-' || l_orderkey AS idempotency_key,
  CAST(floor(coalesce(score, 0) * 100) AS BIGINT) AS amount_cents, CAST(l_partkey AS VARCHAR) AS customer_id FROM {LINES_SQL}""")
def w6(spark, root):
    return lookups.charge_requests(lines(spark, root), F.col("score"), F.col("l_partkey"), F.col("l_orderkey"))


@query("t1_ordered_limit", f"SELECT o_orderkey, o_custkey, o_totalprice FROM orders {ORDER_SQL} LIMIT 100")
def t1(spark, root):
    return lookups.ordered(table(spark, root, "orders"), ORDER, 100).select("o_orderkey", "o_custkey", "o_totalprice")


# Missing values come last.
@query("t1_nulls_last", """SELECT c_custkey, c_acctbal FROM (SELECT c_custkey,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)
  ORDER BY c_acctbal DESC NULLS LAST, c_custkey""")
def t1_nulls(spark, root):
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    return lookups.ordered(table(spark, root, "customer").select("c_custkey", balance), ["c_acctbal", "c_custkey"])
