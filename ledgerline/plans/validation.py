"""Queries: comparison of results, reconciliation, message checks and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import messages, scalars
from ledgerline.operators import validate
from ledgerline.operators.joins import Hop, roll_up
from ledgerline.operators.metrics import ALL_ROWS, NON_NULL, group_metric, partial_sums, total_of
from ledgerline.operators.prepare import unique_texts
from ledgerline.plans.joining import (ASIA_SQL, CUSTOMER_MESSAGES_SQL, EARLY_SQL, ENTITLEMENT_MESSAGES_SQL, TRANSACTION_MESSAGES_SQL, _classified,
                                      customer_messages, entitlement_messages, transaction_messages, two_results)
from ledgerline.plans.metrics import ENTITLED_SQL, MECHANISM_SQL, keyed_sql
from ledgerline.plans.registry import query
from ledgerline.plans.streams import streamed_lines
from ledgerline.plans.tables import LINES_SQL, lines, table, to_nation, to_region


def compare_sql(left: str, right: str) -> str:
    inf = "CAST('inf' AS DOUBLE)"
    gaps = ", ".join(
        f"""CAST(coalesce(max(CASE WHEN a.n_name IS NOT NULL AND b.n_name IS NOT NULL AND (a.{c} IS NULL) <> (b.{c} IS NULL)
    THEN {inf} ELSE abs(a.{c} - b.{c}) END), 0) AS DOUBLE) AS max_{c}_difference"""
        for c in ["txn_count", "score_total", "score_mean"])
    return f"""SELECT *, one_sided_groups = 0 AND max_txn_count_difference = 0 AND max_score_total_difference < 1e-6
  AND max_score_mean_difference < 1e-6 AS passed FROM (SELECT count(a.n_name) AS parallel_groups,
  count(b.n_name) AS baseline_groups, count(*) FILTER (WHERE a.n_name IS NULL OR b.n_name IS NULL) AS one_sided_groups,
  {gaps} FROM ({left}) a FULL JOIN ({right}) b ON a.n_name = b.n_name)"""


@query("v1_same_results", compare_sql(keyed_sql("n_name"), keyed_sql("n_name")))
def v1(spark, root):
    rows, hops = lines(spark, root), to_nation(spark, root)
    return validate.compare_results(
        group_metric(rows, "n_name", "score", hops=hops, scale=0, partitions=4),
        group_metric(rows, "n_name", "score", hops=hops, scale=0), "n_name")


@query("v1_other_null_rule", compare_sql(keyed_sql("n_name"), keyed_sql("n_name", ALL_ROWS)))
def v1_rule(spark, root):
    rows, hops = lines(spark, root), to_nation(spark, root)
    return validate.compare_results(
        group_metric(rows, "n_name", "score", NON_NULL, hops, 0),
        group_metric(rows, "n_name", "score", ALL_ROWS, hops, 0), "n_name")


@query("v1_other_groups", compare_sql(f"SELECT * FROM {ASIA_SQL}", f"SELECT * FROM {EARLY_SQL}"))
def v1_groups(spark, root):
    return validate.compare_results(*two_results(spark, root), "n_name")


def reconcile_sql(current: str, others: dict[str, str]) -> str:
    sides = " UNION ALL ".join(f"""SELECT '{name}' AS source, CAST(sum(a.txn_count) AS BIGINT) AS txn_count_current,
  CAST(sum(b.txn_count) AS BIGINT) AS txn_count_other, sum(a.score_total) AS score_total_current,
  sum(b.score_total) AS score_total_other, max(abs(a.score_total - b.score_total)) AS max_group_difference
  FROM ({current}) a JOIN ({sql}) b ON a.r_name = b.r_name""" for name, sql in others.items())
    return f"""SELECT *, abs(txn_count_current - txn_count_other) AS count_difference,
  abs(score_total_current - score_total_other) AS total_difference, txn_count_current = txn_count_other
  AND abs(score_total_current - score_total_other) <= 1e-6 AND max_group_difference <= 1e-6 AS passed FROM ({sides})"""


@query("v2_reconciliation", reconcile_sql(keyed_sql("r_name", ALL_ROWS), {
    "batch": keyed_sql("r_name"), "stream": keyed_sql("r_name")}))
def v2(spark, root):
    rows, hops = lines(spark, root), to_region(spark, root)
    composed = group_metric(rows, "r_name", "score", ALL_ROWS, hops, 0)
    batch = group_metric(rows, "r_name", "score", NON_NULL, hops, 0)
    return validate.reconcile(composed, {"batch": batch, "stream": streamed_lines(spark, root)}, "r_name")


CONFORMANCE_SQL = """SELECT * REPLACE (CAST(null_count AS VARCHAR) AS null_count) FROM (SELECT 'id_assessment' AS field, 'bigint' AS expected_type, 'bigint' AS actual_type,
  0 AS null_count, 'ok' AS status UNION ALL SELECT 'id_student', 'bigint', 'bigint', 0, 'ok'
  UNION ALL SELECT 'assessment_type', 'string', 'string', 0, 'ok' UNION ALL SELECT 'region', 'string', NULL, NULL, 'missing'
  UNION ALL SELECT 'score', 'double', 'double', (SELECT count(*) FROM lineitem WHERE l_linenumber = 7), 'ok'
  UNION ALL SELECT 'timestamp', 'string', NULL, NULL, 'missing'
  UNION ALL SELECT 'date_submitted', NULL, 'int', (SELECT count(*) FROM lineitem WHERE l_shipdate IS NULL), 'unknown')"""


# Service rows carry date_submitted where the message has timestamp.
@query("v3_conformance", CONFORMANCE_SQL)
def v3(spark, root):
    rows = lines(spark, root).select(
        F.col("l_partkey").alias("id_assessment"), F.col("l_orderkey").alias("id_student"),
        F.col("l_returnflag").alias("assessment_type"), "score",
        F.unix_date(F.col("l_shipdate").cast("date")).alias("date_submitted"))
    # As text, since whole numbers with nulls have no common form in data frames.
    found = messages.conformance(rows, "Transaction")
    return found.withColumn("null_count", F.col("null_count").cast("string"))


def varint_sql(value: str) -> str:
    return f"CASE WHEN {value} < 0 THEN 10 " + " ".join(
        f"WHEN {value} < {2 ** (7 * n)} THEN {n}" for n in range(1, 9)) + " ELSE 9 END"


def whole_size_sql(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN 0 ELSE 1 + {varint_sql(column)} END"


def text_size_sql(column: str) -> str:
    length = f"octet_length(encode({column}))"
    return f"CASE WHEN {column} = '' THEN 0 ELSE 1 + {length} + {varint_sql(length)} END"


def real_size_sql(column: str) -> str:
    return f"CASE WHEN {column} = 0 THEN 0 ELSE 9 END"


def payload_sql(message: str, rows: str, whole: list[str], real: list[str], text: list[str]) -> str:
    names = [f.name for f in messages.fields_of(message)]
    packed = ", ".join(f'"{n}" := "{n}"' for n in names)
    size = " + ".join([whole_size_sql(f'"{c}"') for c in whole] + [real_size_sql(f'"{c}"') for c in real]
                      + [text_size_sql(f'"{c}"') for c in text])
    return f"""SELECT *, json_bytes - protobuf_bytes AS saved,
  CAST(json_bytes - protobuf_bytes AS DOUBLE) / json_bytes * 100 AS reduction_pct FROM (SELECT '{message}' AS message,
  {len(names)} AS fields, count(*) AS row_count,
  CAST(sum(octet_length(encode(CAST(to_json(struct_pack({packed})) AS VARCHAR)))) AS BIGINT) AS json_bytes,
  CAST(sum({size}) AS BIGINT) AS protobuf_bytes FROM ({rows}))"""


@query("v4_transaction_payload", payload_sql(
    "Transaction", TRANSACTION_MESSAGES_SQL, ["id_assessment", "id_student"], ["score"],
    ["assessment_type", "region", "timestamp"]))
def v4(spark, root):
    return messages.payload_sizes(transaction_messages(spark, root), "Transaction")


@query("v4_customer_payload", payload_sql(
    "Customer", CUSTOMER_MESSAGES_SQL, ["id_student"], [], ["gender", "region", "highest_education", "disability"]))
def v4_customers(spark, root):
    return messages.payload_sizes(customer_messages(spark, root), "Customer")


@query("v4_entitlement_payload", payload_sql(
    "Entitlement", ENTITLEMENT_MESSAGES_SQL, ["id_student"], ["date_registration", "date_unregistration"], []))
def v4_entitlements(spark, root):
    return messages.payload_sizes(entitlement_messages(spark, root), "Entitlement")


REVENUE_ROWS_SQL = """SELECT o_orderstatus || ' "' || o_orderpriority || '" é' AS region, o_custkey * 1000 AS transactions,
  o_totalprice * 100 AS revenue_total, o_totalprice / 1000000 AS revenue_mean FROM orders"""


@query("v4_revenue_payload", payload_sql(
    "RegionRevenue", REVENUE_ROWS_SQL, ["transactions"], ["revenue_total", "revenue_mean"], ["region"]))
def v4_revenue(spark, root):
    rows = table(spark, root, "orders").select(
        F.concat("o_orderstatus", F.lit(' "'), "o_orderpriority", F.lit('" é')).alias("region"),
        (F.col("o_custkey") * 1000).alias("transactions"), (F.col("o_totalprice") * 100).alias("revenue_total"),
        (F.col("o_totalprice") / 1000000).alias("revenue_mean"))
    return messages.payload_sizes(rows, "RegionRevenue")


# The report of every order status: its nations, in order, and their totals.
@query("v4_report_payload", f"""SELECT *, json_bytes - protobuf_bytes AS saved,
  CAST(json_bytes - protobuf_bytes AS DOUBLE) / json_bytes * 100 AS reduction_pct
  FROM (SELECT 'RegionalRevenueReport' AS message, 3 AS fields, count(*) AS row_count,
    CAST(sum(octet_length(encode(CAST(to_json(struct_pack(regions := regions, transaction_total := n, revenue_total := total)) AS VARCHAR)))) AS BIGINT) AS json_bytes,
    CAST(sum(list_sum(list_transform(regions, lambda r: 1 + octet_length(encode(r)) + {varint_sql("octet_length(encode(r))")}))
      + {whole_size_sql("n")} + {real_size_sql("total")}) AS BIGINT) AS protobuf_bytes
  FROM (SELECT o_orderstatus, list(n_name ORDER BY n_name) AS regions, CAST(sum(n) AS BIGINT) AS n, CAST(sum(total) AS DOUBLE) AS total
    FROM (SELECT o_orderstatus, n_name, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM orders
      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL) GROUP BY o_orderstatus))""")
def v4_report(spark, root):
    hops = [Hop(table(spark, root, "customer"), "o_custkey", "c_custkey", "customer"), Hop(table(spark, root, "nation"), "c_nationkey", "n_nationkey", "nation", sum_first=False)]
    sums = partial_sums(F.col("o_totalprice"), 2)
    by_nation = roll_up(table(spark, root, "orders"), hops, ["o_orderstatus", "n_name"], sums)
    # A report lists each nation once: as many names as the dimension has.
    reports = by_nation.groupBy("o_orderstatus").agg(F.sort_array(F.collect_set("n_name")).alias("regions"), *[F.sum(c).alias(c) for c in sums])
    return messages.payload_sizes(reports.select("regions", F.col("_rows").alias("transaction_total"), total_of(2).alias("revenue_total")), "RegionalRevenueReport")


@query("v5_round_trip", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS mismatches FROM lineitem")
def v5(spark, root):
    return messages.round_trip(transaction_messages(spark, root))


# Texts with quotes, line ends and other scripts.
@query("v5_text_round_trip", "SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS mismatches FROM documents")
def v5_text(spark, root):
    return messages.round_trip(table(spark, root, "documents"))


@query("v6_same_answer", " UNION ALL ".join(
    f"SELECT *, {n} AS setting FROM ({compare_sql(keyed_sql('n_name'), keyed_sql('n_name'))})" for n in (2, 4, 8)))
def v6(spark, root):
    return validate.same_answer(validate.results_by_setting(lines(spark, root), "n_name", "score", to_nation(spark, root), 0), "n_name")


@query("v6_fingerprints", f"""SELECT s AS setting, count(*) AS groups, true AS agrees
  FROM ({keyed_sql('n_name')}), (SELECT unnest([0, 2, 4, 8])::INTEGER AS s) GROUP BY s""")
def v6_fingerprints(spark, root):
    results = validate.results_by_setting(lines(spark, root), "n_name", "score", to_nation(spark, root), 0)
    found = validate.fingerprints(results, ["n_name", "txn_count", "score_total", "score_mean"])
    return found.select("setting", "groups", "agrees")


@query("x1_mechanism", f"""SELECT mechanism, l_linenumber, count(*) AS events FROM (SELECT {MECHANISM_SQL} AS mechanism,
  l_linenumber FROM {ENTITLED_SQL}) GROUP BY ALL""")
def x1(spark, root):
    return _classified(spark, root).groupBy("mechanism", "l_linenumber").agg(F.count(F.lit(1)).alias("events"))


IDENTIFIER_SQL = """CASE WHEN s = '' THEN 'column' WHEN s[1] BETWEEN '0' AND '9' THEN '_' || s ELSE s END"""


def identifier_sql(text: str, source: str, *others: str) -> str:
    cleaned = f"regexp_replace(regexp_replace(lower({text}), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g')"
    return f"""SELECT {', '.join(others)}, {IDENTIFIER_SQL} AS identifier FROM
  (SELECT {', '.join(others)}, trim({cleaned}, '_') AS s FROM {source})"""


@query("x2_clean_identifier", identifier_sql("url", "pages", "page_id"))
def x2(spark, root):
    return table(spark, root, "pages").select("page_id", scalars.clean_identifier(F.col("url")).alias("identifier"))


@query("x2_clean_priority", identifier_sql("o_orderpriority", "orders", "o_orderkey"))
def x2_priority(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey", scalars.clean_identifier(F.col("o_orderpriority")).alias("identifier"))


@query("c1_clean_text", identifier_sql("text", "documents", "doc_id"))
def c1(spark, root):
    return table(spark, root, "documents").select("doc_id", scalars.clean_identifier(F.col("text")).alias("identifier"))


@query("c2_unique_identifiers", f"""WITH t AS ({identifier_sql("p_name", "part", "p_partkey")}) SELECT p_partkey,
  CASE WHEN n = 1 THEN identifier ELSE identifier || '_' || n END AS unique_text FROM (SELECT *,
  row_number() OVER (PARTITION BY identifier ORDER BY p_partkey) AS n FROM t)""")
def c2(spark, root):
    named = table(spark, root, "part").select(
        "p_partkey", scalars.clean_identifier(F.col("p_name")).alias("identifier"))
    return unique_texts(named, "identifier", "p_partkey").select("p_partkey", "unique_text")


@query("x3_defaults_and_casts", f"""SELECT l_orderkey, l_linenumber, coalesce(score, 0) AS score,
  CAST(coalesce(score, -1) AS BIGINT) AS whole_score FROM {LINES_SQL}""")
def x3(spark, root):
    score = F.col("score")
    return lines(spark, root).select("l_orderkey", "l_linenumber", scalars.or_default(score, 0.0).alias("score"),
                                     scalars.or_default(score, -1.0).cast("bigint").alias("whole_score"))


@query("x4_cents", """SELECT o_orderkey, 'charge-' || o_orderkey AS charge_id,
  CAST(trunc(o_totalprice * 100) AS BIGINT) AS amount_cents FROM orders""")
def x4(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey", F.concat(F.lit("charge-"), F.col("o_orderkey").cast("string")).alias("charge_id"),
        scalars.cents(F.col("o_totalprice")).alias("amount_cents"))


@query("x5_rounded", "SELECT o_orderkey, " + ", ".join(
    f"CAST(printf('%.{d}f', o_totalprice / 7) AS DOUBLE) AS rounded_{d}" for d in (1, 2, 3, 4)) + " FROM orders")
def x5(spark, root):
    value = F.col("o_totalprice") / 7
    return table(spark, root, "orders").select(
        "o_orderkey", *[scalars.rounded(value, d).alias(f"rounded_{d}") for d in (1, 2, 3, 4)])


@query("x6_compact_json", """SELECT event_id, CAST(to_json(struct_pack(event_id := event_id, event_type := event_type,
  "value" := CASE WHEN event_type = 'error' THEN NULL ELSE "value" * 1000000 END, props := props)) AS VARCHAR) AS json
  FROM events""")
def x6(spark, root):
    value = F.when(F.col("event_type") != "error", F.col("value") * 1000000)
    rows = table(spark, root, "events").withColumn("value", value)
    fields = [("event_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")]
    return rows.select("event_id", scalars.json_row(fields).alias("json"))


@query("x6_text_json", """SELECT doc_id, CAST(to_json(struct_pack(doc_id := doc_id, "text" := "text")) AS VARCHAR)
  AS json FROM documents""")
def x6_text(spark, root):
    return table(spark, root, "documents").select(
        "doc_id", scalars.json_row([("doc_id", "bigint"), ("text", "string")]).alias("json"))


@query("x7_differences", f"""SELECT n_name, abs(a.txn_count - b.txn_count) AS count_difference,
  abs(a.score_mean - b.score_mean) AS mean_difference,
  CAST(b.txn_count - a.txn_count AS DOUBLE) / b.txn_count * 100 AS missing_pct
  FROM ({keyed_sql('n_name')}) a JOIN ({keyed_sql('n_name', ALL_ROWS)}) b USING (n_name)""")
def x7(spark, root):
    rows, hops = lines(spark, root), to_nation(spark, root)
    joined = validate.join_results(group_metric(rows, "n_name", "score", NON_NULL, hops, 0),
                                   group_metric(rows, "n_name", "score", ALL_ROWS, hops, 0), "n_name")
    missing = F.col("txn_count_base") - F.col("txn_count_par")
    return joined.select(
        "n_name",
        scalars.absolute_difference(F.col("txn_count_par"), F.col("txn_count_base")).alias("count_difference"),
        scalars.absolute_difference(F.col("score_mean_par"), F.col("score_mean_base")).alias("mean_difference"),
        scalars.percentage(missing, F.col("txn_count_base")).alias("missing_pct"))
