"""The given tables and the roles they play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import Hop
from ledgerline.sources.catalog import ENTITY, EVENT, LOOKUP, RAW, Catalog, Table

TABLES = [
    ("region", LOOKUP, "r_regionkey int, r_name string"),
    ("nation", LOOKUP, "n_nationkey int, n_name string, n_regionkey int"),
    ("customer", ENTITY, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    ("supplier", ENTITY, "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    ("part", LOOKUP, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
                     "p_retailprice double"),
    ("orders", ENTITY, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
                       "o_orderdate timestamp_ntz, o_orderpriority string"),
    ("lineitem", EVENT, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    ("events", EVENT, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                      "props string"),
    ("documents", RAW, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
    ("embeddings", RAW, "vec_id bigint, embedding array<float>, label int"),
    ("pages", RAW, "page_id bigint, url string, html string"),
    ("benchmark", RAW, "item_id bigint, text string"),
    ("labels", RAW, "doc_id bigint, quality int, toxic int"),
    ("conversations", RAW, "conv_id bigint, turn bigint, role string, text string"),
]


def catalog(root: str) -> Catalog:
    return Catalog(root, [Table(name, role, schema, f"{name}.parquet") for name, role, schema in TABLES])


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return catalog(root).read(spark, name)


def score() -> Column:
    """The metric: twice the quantity, missing on every seventh line."""
    return F.when(F.col("l_linenumber") != 7, 2 * F.col("l_quantity")).alias("score")


def lines(spark: SparkSession, root: str) -> DataFrame:
    """The event table with its metric."""
    return table(spark, root, "lineitem").withColumn("score", score())


def to_customer(spark: SparkSession, root: str) -> list[Hop]:
    return [Hop(table(spark, root, "orders"), "l_orderkey", "o_orderkey", "orders"),
            Hop(table(spark, root, "customer"), "o_custkey", "c_custkey", "customer")]


def to_nation(spark: SparkSession, root: str) -> list[Hop]:
    return to_customer(spark, root) + [Hop(table(spark, root, "nation"), "c_nationkey", "n_nationkey", "nation", sum_first=False)]


def to_region(spark: SparkSession, root: str) -> list[Hop]:
    """The many-to-one path from an event to its region."""
    return to_nation(spark, root) + [Hop(table(spark, root, "region"), "n_regionkey", "r_regionkey", "region", sum_first=False)]


def all_parents(spark: SparkSession, root: str) -> list[Hop]:
    """Every parent of an event: the path to its region, and its part."""
    return to_region(spark, root) + [Hop(table(spark, root, "part"), "l_partkey", "p_partkey", "part")]


def entitlements(spark: SparkSession, root: str) -> DataFrame:
    """(customer_id, starts, ends) in days: the first order of a customer and the last urgent one that is finished.

    About half of the customers have no such order, so that open ends occur.
    """
    day = F.unix_date(F.col("o_orderdate").cast("date"))
    closing = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return (
        table(spark, root, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min(day).alias("starts"), F.max(F.when(closing, day)).alias("ends"))
    )


# The same roles for the comparison in SQL.
LINES_SQL = "(SELECT *, CASE WHEN l_linenumber <> 7 THEN 2 * l_quantity END AS score FROM lineitem)"
STAR_SQL = f"""{LINES_SQL} l JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""
ENTITLEMENTS_SQL = """(SELECT o_custkey AS customer_id, min(o_orderdate::DATE) AS starts,
  max(o_orderdate::DATE) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS ends
  FROM orders GROUP BY o_custkey)"""
