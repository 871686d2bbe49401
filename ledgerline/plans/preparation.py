"""Queries: preparation, profiles, integrity and eligibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import prepare, profile
from ledgerline.operators.joins import Hop
from ledgerline.plans.registry import query
from ledgerline.plans.tables import catalog, entitlements, table


def raw_orders(spark, root):
    """Orders as raw rows per customer, with a missing status in place of P and one attribute that never varies."""
    return table(spark, root, "orders").withColumns({
        "status": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
        "cohort": F.col("o_custkey") % 3,
    })


RAW_SQL = """(SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, o_custkey % 3 AS cohort
  FROM orders)"""
ATTRIBUTES = ["status", "o_orderpriority", "o_totalprice", "cohort"]


def varies_sql(column: str) -> str:
    return f"count(DISTINCT {column}) + max(CASE WHEN {column} IS NULL THEN 1 ELSE 0 END) > 1"


PER_KEY_SQL = "SELECT o_custkey, count(*) AS n, " + ", ".join(f"{varies_sql(c)} AS v_{c}" for c in ATTRIBUTES) + \
    f" FROM {RAW_SQL} GROUP BY o_custkey"


@query("p1_attribute_stability", f"WITH k AS ({PER_KEY_SQL}) " + " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, count(*) FILTER (WHERE v_{c}) AS unstable_keys, NOT bool_or(v_{c}) AS stable FROM k"
    for c in ATTRIBUTES))
def p1(spark, root):
    return prepare.attribute_stability(raw_orders(spark, root), "o_custkey", ATTRIBUTES)


@query("p2_first_per_key", f"""SELECT o_custkey, o_orderkey, status, o_orderpriority FROM {RAW_SQL}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def p2(spark, root):
    return prepare.first_per_key(raw_orders(spark, root), "o_custkey", ["o_orderdate", "o_orderkey"],
                                 ["o_orderkey", "status", "o_orderpriority"])


@query("p3_projection", "SELECT p_partkey, p_brand, p_size FROM part")
def p3(spark, root):
    return prepare.keep_columns(table(spark, root, "part"), ["p_partkey", "p_brand", "p_size"])


def uniqueness_sql(source: str, keys: str) -> str:
    return f"""SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_keys,
  count(*) FILTER (WHERE n > 1) AS repeated_keys, CAST(0 AS BIGINT) AS null_keys, max(n) = 1 AS is_unique
  FROM (SELECT {keys}, count(*) AS n FROM {source} GROUP BY {keys})"""


@query("p4_unique_key", uniqueness_sql("part", "p_partkey"))
def p4(spark, root):
    return prepare.key_uniqueness(table(spark, root, "part"), ["p_partkey"])


@query("p4_repeated_key", uniqueness_sql("lineitem", "l_orderkey, l_linenumber"))
def p4_repeated(spark, root):
    return prepare.key_uniqueness(table(spark, root, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("p5_same_population", """SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS in_both,
  count(*) FILTER (WHERE b.k IS NULL) AS left_only, count(*) FILTER (WHERE a.k IS NULL) AS right_only,
  bool_and(a.k IS NOT NULL AND b.k IS NOT NULL) AS same_population
  FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b
  ON a.k = b.k""")
def p5(spark, root):
    return prepare.same_population(table(spark, root, "customer"), "c_custkey",
                                   entitlements(spark, root), "customer_id")


@query("p6_prep_report", f"WITH k AS ({PER_KEY_SQL}) SELECT CAST(sum(n) AS BIGINT) AS source_rows, "
       "count(*) AS output_rows, count(o_custkey) AS distinct_keys, concat_ws(',', "
       + ", ".join(f"CASE WHEN bool_or(v_{c}) THEN '{c}' END" for c in ATTRIBUTES) + ") AS unstable, concat_ws(',', "
       + ", ".join(f"CASE WHEN NOT bool_or(v_{c}) THEN '{c}' END" for c in ATTRIBUTES) + ") AS stable FROM k")
def p6(spark, root):
    return prepare.prep_report(raw_orders(spark, root), "o_custkey", ATTRIBUTES)


PROFILED = ["lineitem", "orders", "customer", "part", "nation", "region"]


def profiled(spark, root):
    return {name: table(spark, root, name) for name in PROFILED}


def with_roles(spark, root):
    tables = catalog(root)
    return {name: (rows, tables.role(name)) for name, rows in profiled(spark, root).items()}


COLUMNS = {t: [c.split()[0] for c in catalog("").tables[t].schema.split(", ")] for t in PROFILED}


def union_sql(part) -> str:
    """A UNION ALL with one part per column of the profiled tables."""
    return " UNION ALL ".join(part(t, c) for t in PROFILED for c in COLUMNS[t])


@query("f1_table_profile", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{catalog('').role(t)}' AS role, count(*) AS row_count, "
    f"CAST({len(COLUMNS[t])} AS BIGINT) AS column_count, '{','.join(COLUMNS[t])}' AS column_names FROM {t}" for t in PROFILED))
def f1(spark, root):
    return profile.table_profile(with_roles(spark, root))


# The bytes of files are beyond SQL over the tables; a test holds them against the file system.
@query("f1_table_bytes")
def f1_bytes(spark, root):
    tables = catalog(root)
    sizes = profile.union([tables.sizes(spark, name) for name in PROFILED])
    rows = profile.table_profile(with_roles(spark, root)).select("table_name", "row_count")
    return sizes.join(rows, "table_name").withColumn("bytes_per_row", F.when(F.col("row_count") > 0, F.col("bytes") / F.col("row_count")))


def column_sql(t: str, c: str) -> str:
    return (f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, "
            f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count, "
            f"count({c}) = count(*) AND count(DISTINCT {c}) = count(*) AS is_candidate_key, "
            f"count(DISTINCT {c}) <= 1 AS is_constant FROM {t}")


PROFILE_SQL = union_sql(column_sql)


@query("f1_column_profile", PROFILE_SQL)
def f1_columns(spark, root):
    return profile.column_profile(profiled(spark, root))


@query("f2_candidate_keys", f"SELECT table_name, column_name FROM ({PROFILE_SQL}) WHERE is_candidate_key")
def f2(spark, root):
    return profile.candidate_keys(profiled(spark, root))


@query("f3_constant_columns", """SELECT c AS column_name, d AS distinct_count FROM (
  SELECT 'currency' AS c, count(DISTINCT currency) AS d FROM t UNION ALL SELECT 'remark', count(DISTINCT remark) FROM t
  UNION ALL SELECT 'o_orderkey', count(DISTINCT o_orderkey) FROM t) WHERE d <= 1""".replace(
    " FROM t", " FROM (SELECT o_orderkey, 'SCORE' AS currency, CAST(NULL AS VARCHAR) AS remark FROM orders)"))
def f3(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", F.lit("SCORE").alias("currency"),
                                                 F.lit(None).cast("string").alias("remark"))
    found = profile.column_profile({"orders": orders}).filter("is_constant")
    return found.select("column_name", "distinct_count")


@query("f4_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {RAW_SQL}"
    for c in [*COLUMNS["orders"], "status", "cohort"]))
def f4(spark, root):
    return profile.null_counts(raw_orders(spark, root))


@query("f5_distinct_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM {RAW_SQL}"
    for c in [*COLUMNS["orders"], "status", "cohort"]))
def f5(spark, root):
    found = profile.column_profile({"orders": raw_orders(spark, root)})
    return found.select("column_name", "distinct_count")


def relations(spark, root):
    """The foreign keys of the tables, and one that has orphans: orders of customers that are in credit."""
    t = profiled(spark, root)
    credit = t["customer"].filter("c_acctbal >= 0")
    return {
        "lineitem.l_orderkey -> orders": (t["lineitem"], Hop(t["orders"], "l_orderkey", "o_orderkey", "orders")),
        "lineitem.l_partkey -> part": (t["lineitem"], Hop(t["part"], "l_partkey", "p_partkey", "part")),
        "orders.o_custkey -> customer": (t["orders"], Hop(t["customer"], "o_custkey", "c_custkey", "customer")),
        "orders.o_custkey -> customer in credit": (t["orders"], Hop(credit, "o_custkey", "c_custkey", "customer")),
    }


def orphans_sql(relation: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return (f"SELECT '{relation}' AS relation, count(*) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys, "
            f"count(*) = 0 AS resolves FROM {child} c WHERE NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})")


INTEGRITY_SQL = " UNION ALL ".join([
    orphans_sql("lineitem.l_orderkey -> orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    orphans_sql("lineitem.l_partkey -> part", "lineitem", "l_partkey", "part", "p_partkey"),
    orphans_sql("orders.o_custkey -> customer", "orders", "o_custkey", "customer", "c_custkey"),
    orphans_sql("orders.o_custkey -> customer in credit", "orders", "o_custkey",
                "(SELECT * FROM customer WHERE c_acctbal >= 0)", "c_custkey"),
])


@query("f6_foreign_keys_resolve", f"SELECT relation, resolves FROM ({INTEGRITY_SQL})")
def f6(spark, root):
    return profile.integrity(relations(spark, root)).select("relation", "resolves")


@query("f7_orphan_counts", INTEGRITY_SQL)
def f7(spark, root):
    return profile.integrity(relations(spark, root))


# A missing child key counts as an orphan.
@query("f7_missing_child_key", """SELECT 'status' AS relation, count(*) AS orphan_rows,
  count(DISTINCT coalesce(status, '?')) AS orphan_keys, count(*) = 0 AS resolves
  FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders) WHERE status IS NULL
  OR status NOT IN (SELECT l_linestatus FROM lineitem)""")
def f7_missing(spark, root):
    statuses = table(spark, root, "lineitem").select("l_linestatus").distinct()
    hop = Hop(statuses, "status", "l_linestatus", "statuses")
    return profile.orphans(raw_orders(spark, root), hop, "status")


CHILDREN_SQL = """SELECT 'o_custkey' AS key, count(*) AS parents, min(n) AS children_min,
  CAST(floor(median(n)) AS BIGINT) AS children_median, max(n) AS children_max, max(n) > 1 AS one_to_many
  FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)"""


@query("f8_children_per_parent", CHILDREN_SQL)
def f8(spark, root):
    return profile.children_per_parent(table(spark, root, "orders"), "o_custkey")


@query("f8_one_to_one", CHILDREN_SQL.replace("'o_custkey' AS key", "'customer_id' AS key").replace(
    "FROM orders", "FROM (SELECT DISTINCT o_custkey FROM orders)"))
def f8_one(spark, root):
    return profile.children_per_parent(entitlements(spark, root), "customer_id")


@query("f9_event_time_range", """SELECT datediff('day', DATE '1970-01-01', min(l_shipdate)::DATE) AS first_day,
  datediff('day', DATE '1970-01-01', max(l_shipdate)::DATE) AS last_day,
  datediff('day', min(l_shipdate)::DATE, max(l_shipdate)::DATE) AS span_days FROM lineitem""")
def f9(spark, root):
    return profile.time_range(table(spark, root, "lineitem"), "l_shipdate")


QUALIFYING = [t for t in PROFILED if catalog("").role(t) in ("Event", "Entity")]


@query("f10_volume", f"""SELECT CAST({len(QUALIFYING)} AS BIGINT) AS qualifying_tables, count(*) AS event_rows,
  {len(QUALIFYING)} >= 3 AS enough_tables, count(*) >= 50000 AS enough_rows FROM lineitem""")
def f10(spark, root):
    return profile.volume(with_roles(spark, root))


CONDITIONS_SQL = f"""SELECT 'related_tables' AS condition, {len(QUALIFYING)} AS measured, {len(QUALIFYING)} >= 3 AS met
  UNION ALL SELECT 'one_to_many', max(n), max(n) > 1
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
  UNION ALL SELECT 'event_time', datediff('day', min(l_shipdate)::DATE, max(l_shipdate)::DATE), count(l_shipdate) > 0
    FROM lineitem
  UNION ALL SELECT 'volume', count(*), count(*) >= 50000 FROM lineitem
  UNION ALL SELECT 'foreign_key ' || relation, orphan_rows, resolves FROM ({INTEGRITY_SQL})"""


def checked(spark, root):
    return profile.conditions(with_roles(spark, root), relations(spark, root), table(spark, root, "lineitem"),
                              "l_orderkey", "l_shipdate")


@query("f11_conditions", CONDITIONS_SQL)
def f11(spark, root):
    return checked(spark, root)


@query("f11_verdict", f"""SELECT count(*) AS conditions, count(*) FILTER (WHERE met) AS conditions_met,
  bool_and(met) AS eligible FROM ({CONDITIONS_SQL})""")
def f11_verdict(spark, root):
    return profile.verdict(checked(spark, root))
