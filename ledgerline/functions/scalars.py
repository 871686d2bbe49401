"""Scalar functions, all as column expressions that stay inside the JVM."""

from __future__ import annotations

import re
from itertools import chain, count

from pyspark.sql import Column
from pyspark.sql import functions as F

# The thresholds and names of the revenue mechanisms.
PASS_SCORE = 40.0
UPSELL_SCORE = 80.0
LOST = "Revenue at risk / lost"
PENDING = "Early intervention / outcome pending"
RESIT = "Resit / repeat revenue"
UPSELL = "Revenue secured + upsell next module"
CONTINUATION = "Revenue secured / continuation revenue"


def mechanism(score: Column, submitted: Column, ended: Column,
              pass_score: float = PASS_SCORE, upsell_score: float = UPSELL_SCORE) -> Column:
    """The revenue mechanism of an event. An event on or after the end is lost, whatever its score.

    `submitted` and `ended` are day numbers and are compared as whole days.
    """
    return (
        F.when(ended.isNotNull() & (submitted.cast("bigint") >= ended.cast("bigint")), LOST)
        .when(score.isNull(), PENDING)
        .when(score < pass_score, RESIT)
        .when(score >= upsell_score, UPSELL)
        .otherwise(CONTINUATION)
    )


def clean_identifier(text: Column) -> Column:
    """A lower-case identifier of letters, digits and single underscores.

    One chain of calls, so that the long text is searched only once.
    """
    name = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.regexp_replace(F.regexp_replace(name, "^$", "column"), "^(?=[0-9])", "_")


def clean_names(names: list[str]) -> list[str]:
    """Column names as clean_identifier makes them, and unique: a repeated one gets the first number from 2 on that no column has."""
    clean = ["_".join(re.findall("[a-z0-9]+", name.lower())) or "column" for name in names]
    result: list[str] = []
    for name in ("_" + c if c[0].isdigit() else c for c in clean):
        result.append(next(n for n in chain([name], (f"{name}_{i}" for i in count(2))) if n not in result))
    return result


def or_default(value: Column, default) -> Column:
    """The value, or a default of the same type in place of a null."""
    return F.coalesce(value, F.lit(default))


def cents(amount: Column) -> Column:
    """Whole cents of an amount, cut towards zero; a missing amount is zero."""
    scaled = F.coalesce(amount.cast("double"), F.lit(0.0)) * 100
    return scaled.cast("bigint")


def rounded(value: Column, digits: int) -> Column:
    """Round the binary value of a double, ties to even, as printf-style formatting does.

    `F.round` works on the shortest decimal text instead: it makes 2.68 of 2.675, which is stored as 2.67499...
    Meant for the few rows of a report.
    """
    return formatted(value, digits).cast("double")


def formatted(value: Column, digits: int) -> Column:
    """A number as text with a fixed count of decimals."""
    return F.regexp_replace(F.format_number(value.cast("double"), digits), ",", "")


def absolute_difference(left: Column, right: Column) -> Column:
    """|left - right|, where a missing side counts as zero."""
    return F.abs(F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0)))


def percentage(part: Column, whole: Column) -> Column:
    """part / whole in percent; 0 for an empty whole."""
    return F.when(whole == 0, 0.0).otherwise(part / whole * 100)


def float_text(value: Column) -> Column:
    """A double as JSON text with plain decimals from 1e-4 up to below 1e16, else with an exponent (1e+16, 1.5e-07)."""
    plain = value.cast("string")  # has an exponent below 1e-3 and from 1e7 on
    magnitude = F.abs(value)
    decimal = F.regexp_replace(value.try_cast("decimal(38, 22)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    power = F.regexp_replace(F.regexp_replace(plain, r"(\.0)?E([0-9])", "e+$2"), r"(\.0)?E-", "e-")
    power = F.regexp_replace(power, "e-([0-9])$", "e-0$1")
    return (
        F.when((magnitude == 0) | ((magnitude >= 1e-3) & (magnitude < 1e7)), plain)
        .when((magnitude >= 1e-4) & (magnitude < 1e16), decimal)
        .otherwise(power)
    )


def _json_text(fields: list[tuple[str, str]]) -> tuple[Column, list[str]]:
    """A row as JSON in which doubles are still quoted, and the names of the doubles."""
    reals = [name for name, kind in fields if kind in ("double", "float")]
    values = [
        (float_text(F.col(f"`{name}`").cast("double")) if name in reals else F.col(f"`{name}`")).alias(name)
        for name, _ in fields
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), reals


def json_row(fields: list[tuple[str, str]]) -> Column:
    """A row as one compact JSON object, with nulls kept. `fields` lists (column, simple type name)."""
    if not fields:
        return F.lit("{}")
    text, reals = _json_text(fields)
    for name in reals:
        # Quotes inside of values are escaped, so this matches the field only.
        text = F.regexp_replace(text, f'"{re.escape(name)}":"([^"]*)"', f'"{name}":$1')
    return text


def json_row_size(fields: list[tuple[str, str]]) -> Column:
    """The bytes of `json_row`, without building its text a second time."""
    if not fields:
        return F.lit(2)
    text, reals = _json_text(fields)
    size = F.octet_length(text)
    for name in reals:
        size = size - F.when(F.col(f"`{name}`").isNull(), 0).otherwise(2)
    return size
