"""Preparation of raw tables: stability of attributes, one row per key, key tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _varies(column: str) -> Column:
    """Whether a column has more than one value within a group, a null being a value.

    Smallest and largest value tell this without collecting distinct values, and merge before the shuffle.
    """
    value = F.col(column)
    mixed = (F.count(value) > 0) & (F.count(value) < F.count(F.lit(1)))
    return mixed | F.coalesce(F.min(value) != F.max(value), F.lit(False))


def attribute_stability(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(attribute, unstable_keys, stable): in how many keys a column takes more than one value."""
    per_key = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(*[_varies(c).alias(c) for c in columns])
    counted = per_key.agg(*[F.count_if(F.col(c)).alias(c) for c in columns])
    long = counted.unpivot([], columns, "attribute", "unstable_keys")
    return long.withColumn("stable", F.col("unstable_keys") == 0)


def first_per_key(rows: DataFrame, key: str, order: list[str], keep: list[str] | None = None) -> DataFrame:
    """The first row of every key in the given order, missing values last, with the columns `keep`.

    The order has to be total within a key. Spark cuts every key to its first row before the shuffle as well
    (WindowGroupLimit), so a hot key does not gather in one task.
    """
    window = W.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order])
    narrow = rows if keep is None else rows.select(*dict.fromkeys([key, *keep, *order]))
    first = narrow.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    return first if keep is None else first.select(key, *[c for c in keep if c != key])


def keep_columns(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Projection to a list of columns."""
    return rows.select(*columns)


def key_uniqueness(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, repeated keys, rows without key, and whether the key is unique."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = rows.groupBy(*keys).count()
    return per_key.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
        F.count_if(complete).alias("distinct_keys"),
        F.count_if(complete & (F.col("count") > 1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(~complete, F.col("count"))), F.lit(0)).alias("null_keys"),
    ).withColumn("is_unique", (F.col("repeated_keys") == 0) & (F.col("null_keys") == 0))


def same_population(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: keys on both sides, on one side only, and whether both sides have the same keys."""
    a = left.select(F.col(left_key).alias("key")).filter("key IS NOT NULL").distinct().withColumn("in_left", F.lit(True))
    b = right.select(F.col(right_key).alias("key")).filter("key IS NOT NULL").distinct().withColumn("in_right", F.lit(True))
    both = a.join(b, "key", "full_outer")
    return both.agg(
        F.count_if(F.col("in_left").isNotNull() & F.col("in_right").isNotNull()).alias("in_both"),
        F.count_if(F.col("in_right").isNull()).alias("left_only"),
        F.count_if(F.col("in_left").isNull()).alias("right_only"),
    ).withColumn("same_population", (F.col("left_only") == 0) & (F.col("right_only") == 0))


def prep_report(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: source rows, rows after taking one per key, distinct keys, and which attributes are (un)stable."""
    present = F.col(key).isNotNull()
    flags = [F.when(present, _varies(c)).alias(c) for c in columns]
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), *flags)
    unstable = [F.max(F.coalesce(F.col(c), F.lit(False))).alias(c) for c in columns]
    report = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("source_rows"),
        F.count(F.lit(1)).alias("output_rows"),
        F.count(key).alias("distinct_keys"),
        *unstable,
    )

    def names(wanted: bool) -> Column:
        return F.concat_ws(",", *[F.when(F.col(c) == F.lit(wanted), c) for c in columns])

    return report.select("source_rows", "output_rows", "distinct_keys", names(True).alias("unstable"),
                         names(False).alias("stable"))


def numbered(rows: DataFrame, key: str, order: str, slices: int = 64) -> DataFrame:
    """Number the rows of every key from 1 in the order of a unique column, nulls last, in the new column `number`.

    One window per key would gather a hot key in one task. Rows are numbered within (key, slice of the order) instead
    and moved up by the rows of the earlier slices, which a window over the few slice counts yields. Slices end at
    measured quantiles, so that gaps in the order leave them even; rows without order are a slice of their own.
    """
    shares = [i / slices for i in range(1, slices)]
    ends = rows.agg(F.percentile_approx(order, shares, 10_000)).first()[0] or []
    at = sum([F.when(F.col(order) > F.lit(end), 1).otherwise(0) for end in sorted(set(ends))], F.lit(0))
    sliced = rows.withColumn("_slice", F.when(F.col(order).isNull(), slices).otherwise(at))
    counts = sliced.groupBy(key, "_slice").count()
    before = W.partitionBy(key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("_key"), F.col("_slice").alias("_at"),
                            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    local = sliced.withColumn("_local", F.row_number().over(W.partitionBy(key, "_slice").orderBy(order)))
    placed = local.join(offsets, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_at")))
    return placed.withColumn("number", F.col("_local") + F.col("_before")).drop(
        "_slice", "_local", "_key", "_at", "_before")


def unique_texts(rows: DataFrame, text: str, order: str, slices: int = 64) -> DataFrame:
    """Texts made unique as data: the second `x` becomes `x_2`, in the new column `unique_text`."""
    n = F.col("number").cast("string")
    return numbered(rows, text, order, slices).withColumn(
        "unique_text", F.when(F.col("number") == 1, F.col(text)).otherwise(F.concat_ws("_", F.col(text), n))
    ).drop("number")
