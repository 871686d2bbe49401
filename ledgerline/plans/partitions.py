"""Queries: partition keys, partition sizes and skew."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators import metrics as m
from ledgerline.operators import partitioning as p
from ledgerline.operators.joins import checked_join, walk
from ledgerline.operators.profile import joined_value_counts
from ledgerline.plans.joining import CREDIT_SQL, credit_path
from ledgerline.plans.metrics import COUNTS_SQL, keyed_sql, nation_counts
from ledgerline.plans.registry import query
from ledgerline.plans.tables import LINES_SQL, STAR_SQL, all_parents, catalog, lines, table, to_nation, to_region

TABLE_NAMES = ["lineitem", "orders", "customer", "nation", "region", "part"]
COLUMNS = {t: [c.split()[0] for c in catalog("").tables[t].schema.split(", ")] for t in TABLE_NAMES}
NEVER = ["l_orderkey", "l_partkey", "l_suppkey", "o_custkey", "score"]
# Keys of parents are the same columns as the keys that refer to them.
PARENT_KEYS = {"o_orderkey", "c_custkey", "n_nationkey", "r_regionkey", "p_partkey"}
JOINED_COLUMNS = [*COLUMNS["lineitem"], "score"] + [
    c for t in TABLE_NAMES[1:] for c in COLUMNS[t] if c not in PARENT_KEYS]


def candidates(spark, root):
    counts = joined_value_counts(lines(spark, root), all_parents(spark, root))
    return p.score_candidates(counts, COLUMNS, NEVER)


def source_of(column: str) -> str:
    return next((t for t in TABLE_NAMES if column in COLUMNS[t]), "computed")


def candidates_sql(joined: str, columns: list[str]) -> str:
    return f"""WITH joined AS MATERIALIZED (SELECT * FROM {joined}),
  counts AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{source_of(c)}' AS source, count(*) AS n FROM joined WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in columns)}),
  stats AS (SELECT column_name, source, count(*) AS distinct_count, min(n) AS min_count,
    CAST(floor(median(n)) AS BIGINT) AS median_count, max(n) AS max_count,
    CAST(printf('%.2f', max(n) / min(n)) AS DOUBLE) AS skew_ratio FROM counts GROUP BY column_name, source),
  hard AS (SELECT *, concat_ws(',',
    CASE WHEN column_name IN ({", ".join(f"'{c}'" for c in NEVER)}) THEN 'identifier' END,
    CASE WHEN distinct_count < 2 THEN 'constant' END,
    CASE WHEN distinct_count > 0.5 * (SELECT count(*) FROM joined) THEN 'near_unique' END) AS reasons FROM stats),
  judged AS (SELECT * EXCLUDE (reasons), CASE WHEN reasons = '' AND skew_ratio = 1 THEN 'uniform' ELSE reasons END AS rejected_because FROM hard)
  SELECT *, rejected_because = '' AS viable FROM judged"""


CANDIDATES_SQL = candidates_sql(f"{STAR_SQL} JOIN part ON p_partkey = l_partkey", JOINED_COLUMNS)


@query("k1_candidate_keys", CANDIDATES_SQL)
def k1(spark, root):
    return candidates(spark, root)


# Customers in debt are no parents here, so that events are lost in the join.
@query("k1_lossy_candidate_keys", candidates_sql(
    f"{LINES_SQL} l JOIN orders ON o_orderkey = l_orderkey JOIN {CREDIT_SQL} c ON c_custkey = o_custkey",
    [c for c in JOINED_COLUMNS if source_of(c) in ("lineitem", "orders", "customer", "computed")]))
def k1_lossy(spark, root):
    counts = joined_value_counts(lines(spark, root), credit_path(spark, root))
    return p.score_candidates(counts, COLUMNS, NEVER)


@query("k2_owning_sources", f"SELECT column_name, source FROM ({CANDIDATES_SQL})")
def k2(spark, root):
    joined = checked_join(lines(spark, root), all_parents(spark, root), validate=False)
    return p.owning_sources(joined.select(JOINED_COLUMNS), COLUMNS)


@query("k3_key_survival", f"""SELECT 'n_name' AS key, 'nation' AS origin, true AS in_join,
  count(*) FILTER (WHERE n_name IS NULL) AS missing, count(*) FILTER (WHERE n_name IS NULL) = 0 AS complete
  FROM {STAR_SQL}""")
def k3(spark, root):
    joined = checked_join(lines(spark, root), to_nation(spark, root), validate=False)
    return p.key_survival(joined, "n_name", COLUMNS)


@query("k3_key_with_nulls", f"""SELECT 'score' AS key, 'computed' AS origin, true AS in_join,
  count(*) FILTER (WHERE score IS NULL) AS missing, false AS complete FROM {LINES_SQL}""")
def k3_nulls(spark, root):
    return p.key_survival(lines(spark, root), "score", COLUMNS)


@query("k4_ranked_candidates", f"""SELECT row_number() OVER (ORDER BY viable DESC, skew_ratio DESC, column_name)
  AS place, column_name, viable, skew_ratio FROM ({CANDIDATES_SQL})""")
def k4(spark, root):
    # The candidates are as many as there are columns; one ordering window holds them.
    place = F.row_number().over(W.orderBy(F.desc("viable"), F.desc("skew_ratio"), "column_name"))
    return p.ranked(candidates(spark, root)).select(
        place.cast("bigint").alias("place"), "column_name", "viable", "skew_ratio")


@query("k5_bounded_repartition", keyed_sql("event_type", source="events", metric="value"))
def k5(spark, root):
    return m.group_metric(table(spark, root, "events"), "event_type", "value", scale=2, partitions=4)


# Murmur3 of a text as Spark computes it: 4-byte words, then single bytes, all mixed alike.
_MASK = "4294967295"


def _rotate(value: str, bits: int) -> str:
    return f"((({value} << {bits}) | ({value} >> {32 - bits})) & {_MASK})"


def _times(value: str, factor: int) -> str:
    return f"CAST((CAST({value} AS UHUGEINT) * {factor}) % 4294967296 AS UBIGINT)"


def murmur3_sql(text: str) -> str:
    """The signed 32-bit hash of an ASCII text, from nested lists and integer arithmetic."""
    words = f"""list_concat(
      list_transform(range(0, length({text}) // 4), lambda i:
        CAST(ascii({text}[4 * i + 1]) + ascii({text}[4 * i + 2]) * 256 + ascii({text}[4 * i + 3]) * 65536
          + CAST(ascii({text}[4 * i + 4]) AS BIGINT) * 16777216 AS UBIGINT)),
      list_transform(range(length({text}) // 4 * 4, length({text})), lambda i:
        CAST(ascii({text}[i + 1]) AS UBIGINT)))"""
    mixed = f"list_transform({words}, lambda w: {_times(_rotate(_times('w', 0xCC9E2D51), 15), 0x1B873593)})"
    step = f"CAST((CAST({_rotate('xor(h, k)', 13)} AS UHUGEINT) * 5 + {0xE6546B64}) % 4294967296 AS UBIGINT)"
    folded = f"list_reduce({mixed}, lambda h, k: {step}, CAST(42 AS UBIGINT))"
    finals = f"xor({folded}, CAST(length({text}) AS UBIGINT))"
    for shift, factor in [(16, 0x85EBCA6B), (13, 0xC2B2AE35)]:
        finals = f"list_transform([{finals}], lambda x: {_times(f'xor(x, x >> {shift})', factor)})[1]"
    finals = f"list_transform([{finals}], lambda x: xor(x, x >> 16))[1]"
    return f"list_transform([{finals}], lambda x: CASE WHEN x >= 2147483648 THEN CAST(x AS BIGINT) - 4294967296 " \
           "ELSE CAST(x AS BIGINT) END)[1]"


SIZES_SQL = f"""WITH hashed AS MATERIALIZED (SELECT value, n, {murmur3_sql("value")} AS hash FROM {COUNTS_SQL}),
  grid AS (SELECT setting, unnest(range(0, setting)) AS part FROM (SELECT unnest([2, 4, 8]) AS setting)),
  sizes AS (SELECT setting, part, CAST(coalesce(sum(n), 0) AS BIGINT) AS record_count FROM grid
    LEFT JOIN hashed ON ((hash % setting) + setting) % setting = part GROUP BY setting, part),
  balance AS (SELECT setting, min(record_count) AS min_records, max(record_count) AS max_records,
    CAST(printf('%.1f', sum(record_count) / setting) AS DOUBLE) AS even_share,
    CASE WHEN min(record_count) = 0 THEN CAST('inf' AS DOUBLE)
      ELSE CAST(printf('%.2f', max(record_count) / min(record_count)) AS DOUBLE) END AS skew_ratio,
    CAST(printf('%.2f', max(record_count) / (sum(record_count) / setting)) AS DOUBLE) AS worst_vs_even
    FROM sizes GROUP BY setting)"""
PARTITIONS_SQL = f"{SIZES_SQL} SELECT setting, CAST(part AS INT) AS partition, record_count FROM sizes"


@query("k6_predicted_partitions", PARTITIONS_SQL)
def k6(spark, root):
    return p.predicted_partitions(nation_counts(spark, root))


@query("k6_measured_partitions", PARTITIONS_SQL)
def k6_measured(spark, root):
    rows, sums = walk(lines(spark, root), to_nation(spark, root), {"n": F.count(F.lit(1))}, ["n_name"])
    return p.measured_partitions(rows, "n_name", total=sums["n"])


@query("k6_partition_balance", f"{SIZES_SQL} SELECT * FROM balance")
def k6_balance(spark, root):
    return p.partition_balance(p.predicted_partitions(nation_counts(spark, root)))


@query("k7_size_table", f"""{SIZES_SQL} SELECT 'spark_partition' AS level, CAST(setting AS VARCHAR) AS setting,
  'partition_' || part AS identifier, record_count, even_share,
  CAST(printf('%.3f', record_count / even_share) AS DOUBLE) AS vs_even FROM sizes JOIN balance USING (setting)
  UNION ALL SELECT 'partition_key', 'n_name', value, n, CAST(printf('%.1f', (sum(n) OVER ()) / (count(*) OVER ()))
  AS DOUBLE), CAST(printf('%.3f', n / ((sum(n) OVER ()) / (count(*) OVER ()))) AS DOUBLE) FROM {COUNTS_SQL}""")
def k7(spark, root):
    return p.size_table(nation_counts(spark, root), "n_name")


@query("k8_skew_trend", f"""{SIZES_SQL} SELECT min(setting) AS first_setting, max(setting) AS last_setting,
  arg_min(skew_ratio, setting) AS first_skew, arg_max(skew_ratio, setting) AS last_skew,
  arg_max(skew_ratio, setting) > arg_min(skew_ratio, setting) AS worsens FROM balance""")
def k8(spark, root):
    return p.skew_trend(p.partition_balance(p.predicted_partitions(nation_counts(spark, root))))


def balanced_sql(counts: str, tolerance: float = 0.1) -> str:
    """Largest first into the emptiest bucket, step by step: the key in turn, what is left of it, and the loads so far."""
    return f"""WITH RECURSIVE keys AS MATERIALIZED (SELECT n, row_number() OVER (ORDER BY n DESC, value) AS place FROM ({counts})),
  facts AS (SELECT setting, sum(n) / setting AS even FROM keys, (SELECT unnest([2, 4, 8]) AS setting) GROUP BY setting),
  steps AS (
    SELECT setting, even, 1::BIGINT AS place, (SELECT n FROM keys WHERE place = 1)::BIGINT AS rest,
      list_transform(range(setting), lambda i: 0::BIGINT) AS loads, 0::BIGINT AS puts, 0::BIGINT AS split_keys FROM facts
    UNION ALL
    SELECT setting, even, CASE WHEN rest = put THEN place + 1 ELSE place END,
      CASE WHEN rest = put THEN coalesce((SELECT n FROM keys k WHERE k.place = moved.place + 1), 0) ELSE rest - put END::BIGINT,
      list_transform(range(setting), lambda i: loads[i + 1] + CASE WHEN i + 1 = list_position(loads, list_min(loads)) THEN put ELSE 0 END),
      CASE WHEN rest = put THEN 0 ELSE puts + 1 END, split_keys + CASE WHEN rest <> put AND puts = 0 THEN 1 ELSE 0 END
    FROM (SELECT *, CASE WHEN list_min(loads) + rest <= even * (1 + {tolerance}) THEN rest
        ELSE least(rest, ceil(even)::BIGINT - list_min(loads)) END::BIGINT AS put FROM steps WHERE rest > 0) moved)
  SELECT setting, list_min(loads) AS min_records, list_max(loads) AS max_records,
    CAST(printf('%.2f', list_max(loads) / even) AS DOUBLE) AS worst_vs_even, split_keys FROM steps WHERE rest = 0"""


@query("k8_balanced_buckets", balanced_sql(f"SELECT value, n FROM {COUNTS_SQL}"))
def k8_balanced(spark, root):
    return p.bucket_balance(nation_counts(spark, root))


# Few keys, most of them above the even share: all of these are split.
@query("k8_balanced_regions", balanced_sql(f"SELECT r_name AS value, count(*) AS n FROM {STAR_SQL} GROUP BY r_name"))
def k8_regions(spark, root):
    rows, sums = walk(lines(spark, root), to_region(spark, root), {"n": F.count(F.lit(1))}, ["r_name"])
    return p.bucket_balance(rows.groupBy(F.col("r_name").alias("value")).agg(sums["n"].alias("n")))
