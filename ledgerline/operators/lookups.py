"""Lookups, ordered retrieval, and projections to messages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ledgerline.functions.scalars import cents
from ledgerline.operators.joins import Hop, checked_join

# The status names.
FOUND = "OK"
NOT_FOUND = "NOT_FOUND"


def lookup(table: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key, or one row with status NOT_FOUND. The key filter reaches the scan; nothing is joined."""
    hits = table.filter(F.col(key) == F.lit(value))
    none = hits.select(F.lit(1)).limit(1).agg(F.count(F.lit(1)).alias("_hits")).filter("_hits = 0")
    empty = [
        (F.lit(value) if f.name == key else F.lit(None)).cast(f.dataType).alias(f.name) for f in table.schema.fields
    ]
    return hits.withColumn("status", F.lit(FOUND)).unionByName(none.select(*empty, F.lit(NOT_FOUND).alias("status")))


def batch_lookup(table: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """One row per distinct asked key (column `key` of `asked`) with its status and, if found, its columns."""
    marked = table.withColumn("_hit", F.lit(True))
    found = asked.select(key).distinct().join(marked, key, "left")
    return found.withColumn("status", F.when(F.col("_hit"), FOUND).otherwise(NOT_FOUND)).drop("_hit")


def found_rows(table: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """The rows of a table whose key is asked for."""
    return table.join(asked.select(key).distinct(), key, "left_semi")


def missing_keys(table: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """The distinct asked keys that the table lacks."""
    return asked.select(key).distinct().join(table.select(key), key, "left_anti")


def ordered(rows: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Rows in the order of several keys with missing values last, cut to the first `limit`.

    The last key should be unique, else ties make the cut arbitrary.
    """
    result = rows.orderBy(*[F.asc_nulls_last(c) for c in order])
    return result if limit is None else result.limit(limit)


@dataclass(frozen=True)
class Cursor:
    """Where a page ended: the values of the order's keys in its last row, and how many rows with just these were served."""

    values: tuple
    served: int


def _after(order: list[str], values: tuple) -> Column:
    """Rows at or behind a place in the order, missing values last. Its first part can be pushed down to the scan."""
    first, value = F.col(order[0]), values[0]
    here = first.isNull() if value is None else first == F.lit(value)
    if len(order) > 1:
        here = here & _after(order[1:], values[1:])
    if value is None:
        return here
    behind = first > F.lit(value)
    return ((first >= F.lit(value)) | first.isNull()) & (behind | first.isNull() | here)


def page(rows: DataFrame, order: list[str], size: int, cursor: Cursor | None = None) -> DataFrame:
    """The next rows in an order, missing values last: at most `size`, and those at the cursor that were served again before them.

    A page is a top-n selection of the rows behind the cursor; nothing is sorted as a whole.
    """
    if cursor is not None:
        rows = rows.filter(_after(order, cursor.values))
    return ordered(rows, order, size + (cursor.served if cursor else 0))


def pages(rows: DataFrame, order: list[str], size: int, cursor: Cursor | None = None) -> Iterator[tuple[list[Row], Cursor]]:
    """Pages of `size` rows and the cursor after each, from which another call goes on. The driver holds one page.

    The other columns break ties, so that only equal rows can tie, and these are counted by the cursor.
    """
    total = [*order, *[c for c in rows.columns if c not in order]]
    while True:
        served = cursor.served if cursor else 0
        found = list(page(rows, total, size, cursor).toLocalIterator())
        own = found[served:]
        if not own:
            return
        last = tuple(own[-1][c] for c in total)
        cursor = Cursor(last, sum(tuple(r[c] for c in total) == last for r in found))
        yield own, cursor


def transactions(events: DataFrame, customers: Hop, definitions: Hop | None, order: list[str],
                 customer_id=None, region: str | None = None, region_column: str = "region",
                 limit: int | None = None) -> DataFrame:
    """Events with their customer and, if any, their definition; filtered, ordered and, if a limit is given, cut.

    The definitions are joined after the cut, once their key is known to be unique.
    A customer filters unless it is None, a region unless it is empty. Both filters reach the scans.
    """
    if customer_id is not None:
        events = events.filter(F.col(customers.child_key) == customer_id)
    if region:
        customers = Hop(customers.parent.filter(F.col(region_column) == region), customers.child_key,
                        customers.parent_key, customers.name)
    joined = checked_join(events, [customers], validate=False)
    if definitions is None:
        return ordered(joined, order, limit or None)
    if limit and set(order) <= set(joined.columns):
        joined = ordered(joined, order, limit)
    return ordered(checked_join(joined, [definitions], how="left"), order, limit or None)


def first_keys(rows: DataFrame, order: list[str], n: int, key: str) -> DataFrame:
    """The distinct keys among the first `n` rows."""
    return ordered(rows, order, n).select(key).distinct()


def message_rows(rows: DataFrame, fields: dict[str, tuple[Column, str]]) -> DataFrame:
    """Project rows to message fields (name -> column, simple type); a missing value becomes 0 or the empty text."""
    defaults = {"bigint": 0, "int": 0, "double": 0.0, "string": ""}
    return rows.select(*[
        F.coalesce(column.cast(kind), F.lit(defaults[kind]).cast(kind)).alias(name)
        for name, (column, kind) in fields.items()
    ])


def charge_requests(rows: DataFrame, amount: Column, customer: Column, key: Column) -> DataFrame:
    """What is asked of a payment service for every row: the amount in cents, the customer, an idempotency key."""
    return rows.select(
        F.concat(F.lit("charge-"), key.cast("string")).alias("idempotency_key"),
        cents(amount).alias("amount_cents"),
        customer.cast("string").alias("customer_id"),
    )
