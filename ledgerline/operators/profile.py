"""Profiles of tables, referential integrity, and the eligibility verdict made from them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.joins import Hop, folded, require_unique
from ledgerline.session import work_dir

MIN_RELATED_TABLES = 3
MIN_EVENT_ROWS = 50_000
_LONG_TEXT = 128


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _family(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "whole"
    return "real" if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType) else "text"


def _comparable(name: str, data_type: T.DataType) -> Column:
    """A column as one of three types that tell the same values apart: bigint, double, or (short) text."""
    value = F.col(f"`{name}`")
    if isinstance(data_type, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(data_type, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp_ltz(value))
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value)
    if _family(data_type) == "whole":
        return value.cast("bigint")
    if _family(data_type) == "real":
        return value.cast("double")
    text = value if isinstance(data_type, T.StringType) else (
        F.to_json(value) if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)) else value.cast("string"))
    # Long texts are shuffled as their SHA-256 digest, under a mark that makes it longer than any text kept as it is.
    digest = F.concat(F.lit("#" * _LONG_TEXT), F.sha2(text, 256))
    return F.when(F.length(text) <= _LONG_TEXT, text).otherwise(digest)


@dataclass(frozen=True)
class Counts:
    """(column_id, value, n): how often each value of some columns occurs. `labels` describe the columns by their id."""

    frame: DataFrame
    labels: list[dict[str, str]]


@dataclass(frozen=True)
class Columns:
    """Columns of one table whose values are to be counted; a row counts `weight` times, or once."""

    rows: DataFrame
    names: list[str]
    labels: dict[str, str]
    weight: str | None = None


def value_counts(tables: list[Columns]) -> list[Counts]:
    """How often each value of each column of some tables occurs, one set of counts per family of types.

    Columns are turned into rows and counted before the shuffle, so columns of few values cost next to nothing and each
    scan reads only the columns of its family. All tables share one shuffle per family.
    """
    found = []
    for family in ("whole", "real", "text"):
        parts, labels = [], []
        for t in tables:
            types = {c: t.rows.schema[c].dataType for c in t.names}
            members = [c for c in t.names if _family(types[c]) == family]
            if members:
                values = F.posexplode(F.array(*[_comparable(c, types[c]) for c in members])).alias("position", "value")
                weight = F.col(t.weight) if t.weight else F.lit(1).cast("bigint")
                long = t.rows.select(weight.alias("weight"), values)
                parts.append(long.select((F.col("position") + len(labels)).alias("column_id"), "value", "weight"))
                labels += [{**t.labels, "column_name": c} for c in members]
        if parts:
            counted = union(parts).groupBy("column_id", "value").agg(F.sum("weight").alias("n"))
            found.append(Counts(counted, labels))
    return found


def key_value_counts(rows: DataFrame, column: str, **labels: str) -> Counts:
    """The same for one column as it is."""
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return Counts(counted.withColumn("column_id", F.lit(0)), [labels or {"column_name": column}])


def frequency_summary(counts: list[Counts]) -> DataFrame:
    """Per column: rows, nulls, distinct values, and the least, middle and largest count of a value.

    Counts are first tallied (how many values occur n times). That tally is short however many values there are, and the
    exact median comes from it.
    """
    names = list(counts[0].labels[0])
    tallies = []
    for part in counts:
        tally = part.frame.groupBy("column_id", F.col("value").isNull().alias("missing"), "n").agg(
            F.count(F.lit(1)).alias("frequency"))
        described = [
            F.element_at(F.array(*[F.lit(label[name]) for label in part.labels]), F.col("column_id") + 1).alias(name)
            for name in names
        ]
        tallies.append(tally.select(*described, "missing", "n", "frequency"))
    n = F.when(~F.col("missing"), F.col("n"))
    frequency = F.when(~F.col("missing"), F.col("frequency"))
    zero = F.lit(0).cast("bigint")
    return union(tallies).groupBy(*names).agg(
        F.sum(F.col("n") * F.col("frequency")).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("missing"), F.col("n"))), zero).alias("null_count"),
        F.coalesce(F.sum(frequency), zero).alias("distinct_count"),
        F.coalesce(F.min(n), zero).alias("min_count"),
        F.coalesce(F.percentile(n, F.lit(0.5), F.coalesce(frequency, zero)).cast("bigint"), zero).alias("median_count"),
        F.coalesce(F.max(n), zero).alias("max_count"),
    )


def column_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of every table: nulls, distinct values, whether it is a candidate key or constant."""
    columns = [Columns(rows, rows.columns, {"table_name": name}) for name, rows in tables.items()]
    summary = frequency_summary(value_counts(columns))
    return summary.select(
        "table_name", "column_name", "row_count", "null_count", "distinct_count",
        ((F.col("null_count") == 0) & (F.col("distinct_count") == F.col("row_count"))).alias("is_candidate_key"),
        (F.col("distinct_count") <= 1).alias("is_constant"),
    )


#: A column is no key if its sketch sees fewer distinct values than this share of the rows: over ten standard errors off.
_FAR_FROM_UNIQUE = 0.8


def possible_keys(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """The columns of every table without nulls whose distinct values, by a sketch, may be as many as the rows.

    Sketches of a few kilobytes per column are merged instead of values; one row per table reaches the driver.
    """
    found = {}
    for name, rows in tables.items():
        types = {f.name: f.dataType for f in rows.schema.fields}
        sketches = [F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(_comparable(c, types[c])), F.lit(12))).alias(f"d{i}") for i, c in enumerate(rows.columns)]
        present = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(rows.columns)]
        row = rows.agg(F.count(F.lit(1)).alias("all"), *present, *sketches).first()
        found[name] = [c for i, c in enumerate(rows.columns) if row[f"n{i}"] == row["all"] and (row[f"d{i}"] or 0) >= _FAR_FROM_UNIQUE * row["all"]]
    return found


def candidate_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) of the columns without nulls whose values are all different.

    Only the columns that sketches leave are counted exactly, so that no values of others are shuffled.
    """
    left = possible_keys(tables)
    narrow = {name: rows.select(*[f"`{c}`" for c in left[name]]) for name, rows in tables.items() if left[name]}
    if not narrow:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "table_name string, column_name string")
    return column_profile(narrow).filter("is_candidate_key").select("table_name", "column_name")


def table_profile(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: role, rows, number and names of the columns. `tables` maps name -> (rows, role)."""
    return union([
        rows.agg(
            F.lit(name).alias("table_name"),
            F.lit(role).alias("role"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(rows.columns)).cast("bigint").alias("column_count"),
            F.lit(",".join(rows.columns)).alias("column_names"),
        )
        for name, (rows, role) in tables.items()
    ])


def null_counts(rows: DataFrame) -> DataFrame:
    """(column_name, null_count) in one pass."""
    counted = rows.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in rows.columns])
    return counted.unpivot([], rows.columns, "column_name", "null_count")


def orphans(children: DataFrame, hop: Hop, relation: str) -> DataFrame:
    """One row: how many child rows (and distinct keys) have no parent, and whether all resolve.

    Children are counted per key first, so a hot key is one row per task. A missing key does not resolve.
    """
    per_key = children.groupBy(F.col(hop.child_key).alias("_key")).count()
    parents = hop.parent.select(F.col(hop.parent_key).alias("_key"))
    return per_key.join(parents, "_key", "left_anti").agg(
        F.lit(relation).alias("relation"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    ).withColumn("resolves", F.col("orphan_rows") == 0)


def integrity(relations: dict[str, tuple[DataFrame, Hop]]) -> DataFrame:
    """The orphans of several foreign keys, one row each."""
    return union([orphans(children, hop, name) for name, (children, hop) in relations.items()])


def children_per_parent(children: DataFrame, key: str) -> DataFrame:
    """One row: least, middle and largest number of children over the parents that have any; one-to-many or not."""
    return frequency_summary([key_value_counts(children, key, key=key)]).select(
        "key",
        F.col("distinct_count").alias("parents"),
        F.col("min_count").alias("children_min"),
        F.col("median_count").alias("children_median"),
        F.col("max_count").alias("children_max"),
        (F.col("max_count") > 1).alias("one_to_many"),
    )


def time_range(rows: DataFrame, column: str) -> DataFrame:
    """One row: first and last event day and the span between them in days. Day offsets and dates both work."""
    day = F.col(column)
    if isinstance(rows.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        day = F.unix_date(day.cast("date"))
    first, last = F.min(day).cast("bigint"), F.max(day).cast("bigint")
    return rows.agg(first.alias("first_day"), last.alias("last_day"), (last - first).alias("span_days"))


def volume(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row: number of tables that are no lookup, rows of the event tables, and whether both suffice."""
    profile = table_profile(tables)
    return profile.agg(
        F.count_if(F.col("role").isin("Event", "Entity")).alias("qualifying_tables"),
        F.coalesce(F.sum(F.when(F.col("role") == "Event", F.col("row_count"))), F.lit(0)).alias("event_rows"),
    ).withColumns({
        "enough_tables": F.col("qualifying_tables") >= MIN_RELATED_TABLES,
        "enough_rows": F.col("event_rows") >= MIN_EVENT_ROWS,
    })


def conditions(tables: dict[str, tuple[DataFrame, str]], relations: dict[str, tuple[DataFrame, Hop]],
               children: DataFrame, child_key: str, event_time: str) -> DataFrame:
    """(condition, measured, met): related tables, one-to-many, event time, volume, and each foreign key."""
    amount = volume(tables)
    span = time_range(children, event_time)
    per_parent = children_per_parent(children, child_key)
    return union([
        amount.select(F.lit("related_tables").alias("condition"), F.col("qualifying_tables").alias("measured"),
                      F.col("enough_tables").alias("met")),
        per_parent.select(F.lit("one_to_many").alias("condition"), F.col("children_max").alias("measured"),
                          F.col("one_to_many").alias("met")),
        span.select(F.lit("event_time").alias("condition"), F.col("span_days").alias("measured"),
                    F.col("span_days").isNotNull().alias("met")),
        amount.select(F.lit("volume").alias("condition"), F.col("event_rows").alias("measured"),
                      F.col("enough_rows").alias("met")),
        integrity(relations).select(F.concat(F.lit("foreign_key "), "relation").alias("condition"),
                                    F.col("orphan_rows").alias("measured"), F.col("resolves").alias("met")),
    ])


def verdict(checked: DataFrame) -> DataFrame:
    """One row: conditions, how many are met, and whether all are."""
    return checked.agg(
        F.count(F.lit(1)).alias("conditions"),
        F.count_if("met").alias("conditions_met"),
        F.bool_and("met").alias("eligible"),
    )


def joined_value_counts(events: DataFrame, hops: list[Hop]) -> list[Counts]:
    """Value counts of every column of the joined rows, without joining the rows.

    A parent column has the value counts of its own table, each row weighted with its number of events, and the weights
    of a parent sum up from those of its children. So every table is unpivoted at its own size. Weights are written once, a
    row per key, since every family of types reads them. Parent keys must be unique.
    Events that lose a parent on the way are left out first; without orphans, which are counted per key, nothing is.
    """
    require_unique(hops)
    child_of = {h.name: next((o.parent for o in hops if h.child_key in o.parent.columns), events) for h in hops}
    lost = integrity({h.name: (events if h.child_key in events.columns else child_of[h.name], h) for h in hops})
    if not lost.filter("NOT resolves").isEmpty():
        for chain in folded(events.columns, hops):
            survivors = chain.parent.select(F.col(chain.parent_key).alias("_survivor"))
            events = events.join(survivors, F.col(chain.child_key) == F.col("_survivor"), "left_semi")
    counted = [Columns(events, events.columns, {})]
    weighted: dict[str, DataFrame] = {}
    for hop in hops:
        child = next((weighted[h.name] for h in hops if h.name in weighted and hop.child_key in h.parent.columns), None)
        per_key = (events.groupBy(F.col(hop.child_key).alias("_child")).agg(F.count(F.lit(1)).alias("_weight"))
                   if child is None else
                   child.groupBy(F.col(hop.child_key).alias("_child")).agg(F.sum("_weight").alias("_weight")))
        path = work_dir(events.sparkSession, "weights")
        per_key.write.parquet(path)
        per_key = events.sparkSession.read.schema(per_key.schema).parquet(path)
        weighted[hop.name] = hop.parent.join(per_key, F.col(hop.parent_key) == F.col("_child")).drop("_child")
        attributes = [c for c in hop.parent.columns if c != hop.parent_key]
        counted.append(Columns(weighted[hop.name], attributes, {}, "_weight"))
    return value_counts(counted)
