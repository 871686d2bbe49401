"""Validated many-to-one joins, and aggregation along them."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """A parent table repeats a key that has to be unique."""


@dataclass(frozen=True)
class Hop:
    """One many-to-one step: `child_key` of the rows so far refers to `parent_key` of `parent`.

    sum_first: whether additive measures are summed per foreign key before this join; not worth it for a parent of a few rows.
    """

    parent: DataFrame
    child_key: str
    parent_key: str
    name: str
    sum_first: bool = True


def key_violations(hops: list[Hop]) -> DataFrame:
    """(parent, parent_key, repeated_keys, null_keys) of every parent, in one job.

    Rows are counted per key before they are shuffled, so a repeated key costs one row per task.
    """
    checks = []
    for hop in hops:
        per_key = hop.parent.groupBy(F.col(hop.parent_key).alias("key")).count()
        checks.append(per_key.agg(
            F.lit(hop.name).alias("parent"),
            F.lit(hop.parent_key).alias("parent_key"),
            F.count_if(F.col("key").isNotNull() & (F.col("count") > 1)).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("count"))), F.lit(0)).alias("null_keys"),
        ))
    return reduce(DataFrame.unionByName, checks)


def require_unique(hops: list[Hop]) -> None:
    """Raise if a parent repeats a key (a missing key may occur once). Runs a job; its result is one row per parent."""
    bad = key_violations(hops).filter("repeated_keys > 0 OR null_keys > 1").collect()
    if bad:
        raise DuplicateKeyError("; ".join(
            f"{r.parent}.{r.parent_key}: {r.repeated_keys} repeated, {r.null_keys} without value" for r in bad
        ))


def checked_join(events: DataFrame, hops: list[Hop], how: str = "inner", validate: bool = True) -> DataFrame:
    """Join every hop after testing that its parent key is unique; keys of the same name become one column.

    Parents of parents are joined to these first, so events are joined, and shuffled, once per key of their own.
    No side is forced to be broadcast: Spark does that by the size of the table (`autoBroadcastJoinThreshold`, and again
    with measured sizes at run time), and splits hot keys of the other joins (`adaptive.skewJoin`).
    """
    if validate:
        require_unique(hops)
    for hop in folded(events.columns, hops, how):
        events = _one_hop(events, hop, how)
    return events


def _one_hop(rows: DataFrame, hop: Hop, how: str) -> DataFrame:
    same = hop.child_key == hop.parent_key
    return rows.join(hop.parent, hop.child_key if same else F.col(hop.child_key) == F.col(hop.parent_key), how)


def folded(columns: list[str], hops: list[Hop], how: str = "inner") -> list[Hop]:
    """The hops whose key is one of `columns`, each with the hops from its parent joined to that parent already."""
    chains: list[Hop] = []
    for hop in hops:
        at = next((i for i, c in enumerate(chains) if hop.child_key in c.parent.columns), None)
        if at is None or hop.child_key in columns:
            chains.append(hop)
        else:
            chains[at] = replace(chains[at], parent=_one_hop(chains[at].parent, hop, how))
    return chains


def lookup_or(rows: DataFrame, hop: Hop, found: str, fallbacks: list[Column], alias: str) -> DataFrame:
    """Left lookup of one parent column, or the first fallback that has a value."""
    require_unique([hop])
    parent = hop.parent.select(F.col(hop.parent_key).alias("_key"), F.col(found).alias("_found"))
    joined = rows.join(parent, F.col(hop.child_key) == F.col("_key"), "left")
    return joined.withColumn(alias, F.coalesce("_found", *fallbacks)).drop("_key", "_found")


def walk(events: DataFrame, hops: list[Hop], sums: dict[str, Column],
         carry: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Follow many-to-one joins with additive measures, keeping the columns `carry` of events and parents.

    Before a hop the measures are summed per foreign key and the keys still needed, unless the hop says otherwise, so that a
    key with a third of all events reaches the join as few rows, and every step shuffles fewer. Where columns of the events
    themselves are carried, such sums would hardly shorten anything; rows are then joined as they are, to chains of parents
    joined beforehand, and Spark splits hot keys of the join (`adaptive.skewJoin`).
    Returns the rows and the aggregates that finish the sums; the result is the same whichever way is taken.
    """
    child_keys = [hop.child_key for hop in hops]
    rows = events
    if set(carry) & set(events.columns):
        slim, seen = [], set(events.columns)
        for i, hop in enumerate(hops):
            kept = [c for c in hop.parent.columns if c in {*child_keys, *carry} - seen]
            seen.update(kept)
            slim.append(replace(hop, parent=hop.parent.select(F.col(hop.parent_key).alias(f"_key{i}"), *kept), parent_key=f"_key{i}"))
        return checked_join(events, slim, validate=False).drop(*[hop.parent_key for hop in slim]), sums
    for i, hop in enumerate(hops):
        later = {*child_keys[i + 1:], *carry}
        parent = hop.parent.select(
            F.col(hop.parent_key).alias("_parent_key"),
            *[c for c in hop.parent.columns if c in later and c not in rows.columns],
        )
        if hop.sum_first:
            kept = [c for c in rows.columns if c in {*child_keys[i:], *carry}]
            rows = rows.groupBy(*kept).agg(*(total.alias(name) for name, total in sums.items()))
            sums = {name: F.sum(name) for name in sums}
        rows = rows.join(parent, F.col(hop.child_key) == F.col("_parent_key")).drop("_parent_key")
    return rows, sums


def roll_up(events: DataFrame, hops: list[Hop], keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Additive measures of the events, grouped by columns that may lie some many-to-one joins away."""
    rows, sums = walk(events, hops, sums, keys)
    return rows.groupBy(*keys).agg(*(total.alias(name) for name, total in sums.items()))
