"""Queries: sources, sinks and typing. Files are written below the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline.operators import typing
from ledgerline.operators.metrics import ALL_ROWS, NON_NULL, group_metric, service_names
from ledgerline.plans.metrics import keyed_sql
from ledgerline.plans.preparation import raw_orders
from ledgerline.plans.registry import query
from ledgerline.plans.tables import LINES_SQL, TABLES, catalog, lines, table, to_nation
from ledgerline.session import work_dir
from ledgerline.sources import files
from ledgerline.sources.catalog import run_sql, table_counts

LISTING_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{role}' AS role, count(*) AS row_count FROM {name}" for name, role, _ in TABLES)


@query("io1_catalog_views", "SELECT n_name, count(*) AS customers FROM customer JOIN nation "
       "ON n_nationkey = c_nationkey GROUP BY n_name")
def io1(spark, root):
    catalog(root).register_views(spark, "catalog_")
    return spark.sql("SELECT n_name, count(*) AS customers FROM catalog_customer JOIN catalog_nation "
                     "ON n_nationkey = c_nationkey GROUP BY n_name")


EXPORTED = "o_orderkey bigint, o_custkey bigint, status string, cohort bigint, o_totalprice double, paid double"


def exported(spark, root):
    """Orders with missing texts and numbers, for files."""
    paid = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    return raw_orders(spark, root).select("o_orderkey", "o_custkey", "status", "cohort", "o_totalprice", paid.alias("paid"))


EXPORTED_SQL = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  o_custkey % 3 AS cohort, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS paid FROM orders"""


@query("io2_csv_scan", EXPORTED_SQL)
def io2(spark, root):
    path = work_dir(spark, "csv")
    # Quoting every value writes a missing number as a quoted empty text.
    exported(spark, root).write.option("header", True).option("quoteAll", True).csv(path)
    return files.read_csv(spark, path, EXPORTED)


@query("io3_parquet_sink", EXPORTED_SQL)
def io3(spark, root):
    path = work_dir(spark, "parquet")
    files.write_parquet(exported(spark, root), path)
    return spark.read.schema(EXPORTED).parquet(path)


@query("io3_partitioned_parquet", EXPORTED_SQL)
def io3_partitioned(spark, root):
    path = work_dir(spark, "parquet")
    files.write_parquet(exported(spark, root), path, ["status"])
    return spark.read.schema(EXPORTED).parquet(path)


@query("io4_formatted_csv", f"""SELECT n_name, txn_count AS transactions,
  printf('%.2f', score_total) AS revenue_total, printf('%.4f', score_mean) AS revenue_mean
  FROM ({keyed_sql('n_name', ALL_ROWS)})""")
def io4(spark, root):
    path = work_dir(spark, "csv")
    result = service_names(group_metric(lines(spark, root), "n_name", "score", ALL_ROWS, to_nation(spark, root), 0))
    files.write_csv(result, path, ["n_name"], {"revenue_total": 2, "revenue_mean": 4})
    return files.read_csv(spark, path, "n_name string, transactions bigint, revenue_total string, revenue_mean string")


@query("io5_json_report", f"""SELECT count(*) AS groups, CAST(sum(txn_count) AS BIGINT) AS txn_count,
  sum(score_total) AS score_total FROM ({keyed_sql('n_name')})""")
def io5(spark, root):
    path = work_dir(spark, "json")
    result = group_metric(lines(spark, root), "n_name", "score", NON_NULL, to_nation(spark, root), 0)
    report = result.agg(F.count(F.lit(1)).alias("groups"), F.struct(
        F.sum("txn_count").alias("txn_count"), F.sum("score_total").alias("score_total")).alias("totals"))
    files.write_json(report, path)
    stored = spark.read.schema("groups bigint, totals struct<txn_count: bigint, score_total: double>").json(path)
    return stored.select("groups", "totals.*")


@query("io6_stored_result", f"SELECT n_name, txn_count, score_total FROM ({keyed_sql('n_name', ALL_ROWS)})")
def io6(spark, root):
    path = work_dir(spark, "csv")
    result = service_names(group_metric(lines(spark, root), "n_name", "score", ALL_ROWS, to_nation(spark, root), 0))
    files.write_csv(result, path, ["n_name"])
    return files.load_result(spark, path, "n_name")


def as_texts(rows, *columns):
    """Whole numbers with nulls as text, since they have no common form in data frames."""
    return rows.withColumns({c: F.col(c).cast("string") for c in columns})


@query("io7_typed_table", """SELECT o_orderkey AS order_key, o_custkey AS order_key_2, o_totalprice AS _2nd_price,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
  CAST(CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS VARCHAR) AS "column", o_orderstatus = 'F' AS is_final FROM orders""")
def io7(spark, root):
    path = work_dir(spark, "csv")
    rows = raw_orders(spark, root).select(
        "o_orderkey", "o_custkey", "o_totalprice", "status",
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).cast("string"), F.col("o_orderstatus") == "F")
    awkward = rows.toDF("Order Key", "order--key!", "2nd price", " Status ", "??", "is_final")
    awkward.write.option("header", True).csv(path)
    name = f"typed_orders_{uuid.uuid4().hex}"
    files.load_table(spark, path, name, work_dir(spark, "table"))
    return as_texts(spark.table(name), "column")


@query("io8_ad_hoc_sql", """SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
  AND c_acctbal > 5000""")
def io8(spark, root):
    catalog(root).register_views(spark, "catalog_")
    return run_sql(spark, "SELECT c_custkey, c_name, c_acctbal FROM catalog_customer "
                          "WHERE c_mktsegment = :segment AND c_acctbal > :least", {"segment": "BUILDING", "least": 5000})


@query("io9_table_listing", LISTING_SQL)
def io9(spark, root):
    return table_counts(spark, catalog(root))


def as_text(spark, root):
    """Every value of the event table as text, with one column that is whole but for some rows and one of marks."""
    rows = lines(spark, root).withColumns({
        "mostly_whole": F.when(F.col("l_linenumber") == 1, F.col("l_discount")).otherwise(F.lit(3)).cast("string"),
        "flag": F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("False")),
        "mixed": F.when(F.col("l_linenumber") == 2, "n.a.").otherwise(F.col("l_linenumber").cast("string")),
        "nothing": F.lit(None).cast("string"),
    })
    texts = ["l_orderkey", "l_quantity", "l_extendedprice", "l_linestatus", "score", "mostly_whole", "flag", "mixed", "nothing"]
    return rows.select("l_suppkey", "l_tax", *[F.col(c).cast("string").alias(c) for c in texts])


def inferred_sql(column: str) -> str:
    number = f"TRY_CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS column_name, CASE
  WHEN count({column}) = 0 THEN 'TEXT'
  WHEN count(*) FILTER (WHERE lower({column}) NOT IN ('true', 'false')) = 0 THEN 'BOOLEAN'
  WHEN count(*) FILTER (WHERE {column} IS NOT NULL AND {number} IS NULL) > 0 THEN 'TEXT'
  WHEN count(*) FILTER (WHERE {number} % 1 <> 0) = 0 THEN 'BIGINT' ELSE 'DOUBLE PRECISION' END AS inferred_type FROM t"""


TEXT_SQL = f"""t AS (SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS VARCHAR) AS l_quantity,
  CAST(l_extendedprice AS VARCHAR) AS l_extendedprice, l_linestatus, CAST(score AS VARCHAR) AS score,
  CASE WHEN l_linenumber = 1 THEN CAST(l_discount AS VARCHAR) ELSE '3.0' END AS mostly_whole,
  CASE WHEN l_returnflag = 'R' THEN 'True' ELSE 'False' END AS flag,
  CASE WHEN l_linenumber = 2 THEN 'n.a.' ELSE CAST(l_linenumber AS VARCHAR) END AS mixed,
  CAST(NULL AS VARCHAR) AS nothing FROM {LINES_SQL})"""


@query("c3_inferred_types", f"WITH {TEXT_SQL} " + " UNION ALL ".join(
    inferred_sql(c) for c in ["l_orderkey", "l_quantity", "l_extendedprice", "l_linestatus", "score", "mostly_whole",
                              "flag", "mixed", "nothing"])
       + " UNION ALL SELECT 'l_suppkey', 'BIGINT' UNION ALL SELECT 'l_tax', 'DOUBLE PRECISION'")
def c3(spark, root):
    return typing.infer_types(as_text(spark, root))


CONFORMED = {"l_orderkey": typing.BIGINT, "l_extendedprice": typing.BIGINT, "score": typing.BIGINT,
             "mostly_whole": typing.DOUBLE, "flag": typing.BOOLEAN, "mixed": typing.BIGINT, "l_linestatus": typing.TEXT}


@query("c4_conformed_values", f"""WITH {TEXT_SQL} SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey,
  CAST(round_even(CAST(l_extendedprice AS DOUBLE), 0) AS BIGINT) AS l_extendedprice,
  CAST(CAST(CAST(score AS DOUBLE) AS BIGINT) AS VARCHAR) AS score, CAST(mostly_whole AS DOUBLE) AS mostly_whole,
  CAST(flag AS BOOLEAN) AS flag, CAST(TRY_CAST(mixed AS BIGINT) AS VARCHAR) AS mixed, l_linestatus FROM t""")
def c4(spark, root):
    return as_texts(typing.conform(as_text(spark, root).select(*CONFORMED), CONFORMED), "score", "mixed")


@query("c4_changed_values", f"WITH {TEXT_SQL} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {"TRY_CAST(" + c + " AS DOUBLE) % 1 <> 0"
        if k == typing.BIGINT else "false"}) AS rounded_values, {"count(*) FILTER (WHERE mixed = 'n.a.')"
        if c == "mixed" else "0"} AS lost_values FROM t""" for c, k in CONFORMED.items()))
def c4_changed(spark, root):
    return typing.changed_values(as_text(spark, root).select(*CONFORMED), CONFORMED)
