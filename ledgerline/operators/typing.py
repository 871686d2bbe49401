"""Typing of text columns: inference over all rows, and conforming values to the chosen type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BIGINT, DOUBLE, BOOLEAN, TEXT = "BIGINT", "DOUBLE PRECISION", "BOOLEAN", "TEXT"
# A failing cast is slow, so casts only see texts of these forms. This also keeps out the suffixes of Java literals,
# such as 12d.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _whole(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def _logical(text: Column) -> Column:
    return F.lower(text).isin("true", "false")


def _named(column: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), column + 1).alias("column_name")


def _long(rows: DataFrame, names: list[str]) -> DataFrame:
    """(position, value) of some text columns: one test expression then serves them all and stays compilable."""
    return rows.select(F.posexplode(F.array(*[F.col(f"`{n}`") for n in names])).alias("position", "value"))


def infer_types(rows: DataFrame) -> DataFrame:
    """(column_name, inferred_type): aggregates over all rows, of a few columns each.

    Typed columns keep their kind. Text is numeric only if every value is, and whole only if every value is.
    """
    texts = [f.name for f in rows.schema.fields if isinstance(f.dataType, T.StringType)]
    known = []
    for field in rows.schema.fields:
        if field.name not in texts:
            kind = (BOOLEAN if isinstance(field.dataType, T.BooleanType) else
                    BIGINT if isinstance(field.dataType, T.IntegralType) else
                    DOUBLE if isinstance(field.dataType, T.FractionalType) else TEXT)
            known.append((field.name, kind))
    result = rows.sparkSession.createDataFrame(known, "column_name string, inferred_type string")
    for at in range(0, len(texts), _AT_ONCE):
        part = texts[at : at + _AT_ONCE]
        seen = rows.agg(*[F.bit_or(_what(F.col(f"`{c}`"))).alias(str(i)) for i, c in enumerate(part)])
        kind = F.when(F.col("seen") == 1, BOOLEAN).when(F.col("seen") == 2, BIGINT).when(
            F.col("seen").isin(4, 6), DOUBLE).otherwise(TEXT)  # without any row there is nothing to see, and the column is text
        long = seen.unpivot([], seen.columns, "position", "seen")
        result = result.unionByName(long.select(_named(F.col("position").cast("int"), part), kind.alias("inferred_type")))
    return result


#: Columns of one aggregate: more would outgrow what the compiler takes.
_AT_ONCE = 8


def _what(value: Column) -> Column:
    """A bit for the kind of a value: 1 true or false, 2 whole, 4 fractional, 8 other text; 0 for a null."""
    return (
        F.when(value.isNull(), 0)
        .when(value.rlike(_WHOLE), 2)
        .when(value.rlike(_NUMBER), F.when(value.try_cast("double") % 1 == 0, 2).otherwise(4))
        .when(_logical(value), 1)
        .otherwise(8)
    )


def conformed(text: Column, kind: str) -> Column:
    """A text value in the chosen type; whole numbers are rounded, ties to even. What does not fit becomes null."""
    if kind == BIGINT:
        return F.coalesce(_whole(text), F.rint(_number(text)).try_cast("bigint"))
    if kind == DOUBLE:
        return _number(text)
    return F.when(_logical(text), F.lower(text) == "true") if kind == BOOLEAN else text


def conform(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns to their types."""
    return rows.select(*[conformed(F.col(f"`{c}`"), types[c]).alias(c) for c in rows.columns])


def changed_values(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """(column_name, rounded_values, lost_values): what conforming text columns changes silently."""
    value = F.col("value")
    parts = []
    for kind in (BIGINT, DOUBLE, BOOLEAN, TEXT):
        names = [c for c in rows.columns if types[c] == kind]
        if not names:
            continue
        lost = value.isNotNull() & conformed(value, kind).isNull()
        rounded = F.lit(False)
        if kind == BIGINT:
            rounded = value.isNotNull() & ~value.rlike(_WHOLE) & (_number(value) % 1 != 0)
        counted = _long(rows, names).groupBy("position").agg(
            F.count_if(rounded).alias("rounded_values"), F.count_if(lost).alias("lost_values"))
        parts.append(counted.select(_named(F.col("position"), names), "rounded_values", "lost_values"))
    return reduce(DataFrame.unionByName, parts)
