"""Keyed revenue measures under three explicit null rules, and the reports made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import mechanism
from ledgerline.operators.joins import Hop, roll_up, walk

# What a missing metric means.
NON_NULL = "non-null"    # it is no transaction: left out of count and mean; rows without key are left out too
COALESCED = "coalesced"  # as above, but a group of missing metrics only has total and mean 0
ALL_ROWS = "all-rows"    # it is a transaction worth 0: part of count and mean


#: Bits of the lower limb of a total: its sum holds for 2^43 rows, that of the upper limb up to totals of 2^83 units.
_LIMB = 20
_TOTAL = "_total"


def total_parts(value: Column, scale: int | None) -> dict[str, Column]:
    """Additive parts of an exact total: they can be summed again at any later step, and `total_of` puts them together.

    A value counts as whole units of `scale` decimals. Units are summed as two 64-bit limbs, which is exact in any
    order and beyond 64 bits without the cost of decimals; values with more decimals than that are counted, and refused
    in the end. Without a scale the total is a plain sum of doubles.
    """
    if scale is None:
        return {_TOTAL: F.sum(value.cast("double"))}
    unit = 10**scale
    whole = F.floor(value).cast("bigint")
    units = whole * F.lit(unit).cast("bigint") + F.floor((value - whole) * F.lit(float(unit)) + F.lit(0.5))
    # From 2^53 units on, doubles lie further apart than units.
    rounded = (F.abs(units) < 2**53) & (units.cast("double") / F.lit(float(unit)) != value.cast("double"))
    return {f"{_TOTAL}_high": F.sum(F.shiftright(units, _LIMB)), f"{_TOTAL}_low": F.sum(units.bitwiseAND(2**_LIMB - 1)),
            f"{_TOTAL}_refused": F.count_if(rounded)}


def total_of(scale: int | None, parts: dict[str, Column] | None = None) -> Column:
    """The total as a double, null if there is no value; the parts are columns of these names unless given."""
    part = lambda name: (parts or {}).get(name, F.col(name))
    if scale is None:
        return part(_TOTAL)
    high, low, refused = (part(f"{_TOTAL}_{end}") for end in ("high", "low", "refused"))
    units = high.cast("decimal(28,0)") * F.lit(2**_LIMB).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    exact = F.concat(units.cast("string"), F.lit(f"E-{scale}")).cast("double")  # rounded once, at the end
    said = F.concat(refused.cast("string"), F.lit(f" values have more than {scale} decimals"))
    return F.when(refused > 0, F.raise_error(said).cast("double")).otherwise(exact)


def partial_sums(metric: Column, scale: int | None) -> dict[str, Column]:
    """Additive parts of all three definitions; they can be summed again at any later step."""
    return {"_rows": F.count(F.lit(1)), "_values": F.count(metric), **total_parts(metric, scale)}


def finish(parts: DataFrame, key: str, definition: str, scale: int | None) -> DataFrame:
    """(key, txn_count, score_total, score_mean) from the additive parts."""
    total = F.coalesce(total_of(scale), F.lit(0.0))
    count = F.col("_rows" if definition == ALL_ROWS else "_values")
    mean = F.when(count > 0, total / count)
    if definition == NON_NULL:
        parts = parts.filter(F.col(key).isNotNull())
    else:
        mean = F.coalesce(mean, F.lit(0.0))
    return parts.select(key, count.alias("txn_count"), total.alias("score_total"), mean.alias("score_mean"))


def group_metric(events: DataFrame, key: str, metric: str, definition: str = NON_NULL, hops: list[Hop] | None = None,
                 scale: int | None = None, partitions: int | None = None) -> DataFrame:
    """Count, total and mean of a metric per key; the key may lie behind many-to-one joins (`hops`).

    `scale` is the number of decimals the metric has; with it totals are exact in any order of summation.
    `partitions` bounds the parallelism of the last step by a hash partitioning of the partial sums on the key;
    shuffling the rows themselves would send a whole key to one task.
    """
    sums = partial_sums(F.col(metric), scale)
    if partitions is None:
        return finish(roll_up(events, hops or [], [key], sums), key, definition, scale)
    rows, sums = walk(events, hops or [], sums, [key])
    parts = rows.withColumn("_task", F.spark_partition_id()).groupBy(key, "_task").agg(
        *(total.alias(name) for name, total in sums.items()))
    merged = parts.repartition(partitions, key).groupBy(key).agg(*(F.sum(name).alias(name) for name in sums))
    return finish(merged, key, definition, scale)


def service_names(result: DataFrame) -> DataFrame:
    """The column names of the composed service report."""
    return result.withColumnsRenamed(
        {"txn_count": "transactions", "score_total": "revenue_total", "score_mean": "revenue_mean"}
    )


def regional_revenue(events: DataFrame, key: str, metric: str, hops: list[Hop] | None = None,
                     region: str | None = None, limit: int | None = None, scale: int | None = None) -> DataFrame:
    """The coalesced definition, sorted by key, optionally of one key or of the first `limit` keys."""
    result = service_names(group_metric(events, key, metric, COALESCED, hops, scale))
    if region:
        result = result.filter(F.col(key) == region)
    result = result.orderBy(F.asc_nulls_last(key))
    return result.limit(limit) if limit else result


def revenue_report(result: DataFrame, key: str, count: str = "transactions", total: str = "revenue_total") -> DataFrame:
    """One row from a keyed result: the sorted keys, all transactions, all revenue.

    The message lists all keys in one row, so it is for keys of a dimension (regions), not of events.
    """
    return result.agg(
        F.sort_array(F.collect_set(key)).alias("regions"),
        F.coalesce(F.sum(count), F.lit(0)).alias("transaction_total"),
        F.coalesce(F.sum(total), F.lit(0.0)).alias("revenue_total"),
    )


def grand_total(result: DataFrame, count: str = "txn_count", total: str = "score_total") -> DataFrame:
    """Count and total over all groups."""
    return result.agg(F.sum(count).alias("txn_count"), F.sum(total).alias("score_total"))


def top_groups(result: DataFrame, key: str, n: int, total: str = "score_total") -> DataFrame:
    """The `n` groups of the largest total; ties in key order."""
    return result.orderBy(F.desc(total), F.asc(key)).limit(n)


def table_summary(rows: DataFrame, value: str, scale: int | None = None) -> DataFrame:
    """Row count and total of a whole table."""
    total = total_of(scale, total_parts(F.col(value), scale))
    return rows.agg(F.count(F.lit(1)).alias("events"), F.coalesce(total, F.lit(0.0)).alias("revenue_total"))


def mechanism_breakdown(events: DataFrame, hops: list[Hop], metric: str, submitted: str, ended: str,
                        scale: int | None = None) -> DataFrame:
    """Events and revenue per mechanism; the last hop brings the end of the entitlement.

    The mechanism needs metric, day and end of one event together, so events are joined row by row and summed after.
    """
    sums = {"events": F.count(F.lit(1)), **total_parts(F.col(metric), scale)}
    rows, sums = walk(events, hops, sums, [metric, submitted, ended])
    label = mechanism(F.col(metric), F.col(submitted), F.col(ended)).alias("mechanism")
    total = F.coalesce(total_of(scale, sums), F.lit(0.0))
    return rows.groupBy(label).agg(sums["events"].alias("events"), total.alias("revenue_proxy"))
