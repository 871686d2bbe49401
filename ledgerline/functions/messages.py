"""Typed messages: contracts, conformance of rows, and encoded sizes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.scalars import json_row_size

# The messages. Fields are numbered from 1 in the order written here.
MESSAGES = {
    "Empty": "",
    "Count": "value int64",
    "RpcError": "code string, message string, details string",
    "ChargeRequest": "amount_cents int64, customer_id string, currency string, idempotency_key string, delay_ms int32",
    "ChargeResult": "charge_id string, status string, amount_cents int64, provider string",
    "ConfigRequest": "config_id string",
    "MonetizationConfig": "config_id string, name string, pass_score double, upsell_score double, "
                          "proxy_metric string, note string",
    "ConfigList": "configs repeated string",
    "CustomerRequest": "customer_id int64",
    "CustomerBatchRequest": "customer_ids repeated int64",
    "Customer": "id_student int64, gender string, region string, highest_education string, disability string",
    "CustomerBatch": "customers repeated string",
    "EntitlementRequest": "customer_id int64",
    "Entitlement": "id_student int64, date_registration double, date_unregistration double",
    "RevenueQuery": "region string, limit int32",
    "RegionRevenue": "region string, transactions int64, revenue_total double, revenue_mean double",
    "RegionalRevenueReport": "regions repeated string, transaction_total int64, revenue_total double",
    "TransactionQuery": "customer_id int64, region string, limit int32",
    "Transaction": "id_assessment int64, id_student int64, assessment_type string, region string, score double, "
                   "timestamp string",
    "TransactionList": "transactions repeated string",
}

# The one monetization configuration.
CONFIGS = [
    ("oulad-score-proxy", "OULAD score proxy", 40.0, 80.0, "score",
     "Score is a reconciliation proxy; OULAD has no native transaction revenue field."),
]

_SPARK = {"int64": "bigint", "int32": "int", "bool": "boolean", "double": "double", "string": "string"}


@dataclass(frozen=True)
class Field:
    name: str
    number: int
    kind: str
    repeated: bool

    @property
    def spark_type(self) -> str:
        return f"array<{_SPARK[self.kind]}>" if self.repeated else _SPARK[self.kind]


def fields_of(message: str) -> list[Field]:
    parts = [p.split() for p in MESSAGES[message].split(", ") if p]
    return [Field(p[0], i, p[-1], "repeated" in p) for i, p in enumerate(parts, 1)]


def message_schema(message: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.spark_type)) for f in fields_of(message)])


def configs(spark: SparkSession) -> DataFrame:
    """The configurations as rows, for lookups."""
    return spark.createDataFrame(CONFIGS, message_schema("MonetizationConfig"))


def conformance(rows: DataFrame, message: str) -> DataFrame:
    """One row per field of the rows or the message: types, nulls, and whether it fits.

    Fields are matched by name. Names are metadata; the nulls are counted in one pass over all rows.
    """
    expected = {f.name: f.spark_type for f in fields_of(message)}
    actual = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    names = list(dict.fromkeys([*expected, *actual]))
    nulls = rows.agg(*[
        (F.count_if(F.col(f"`{n}`").isNull()) if n in actual else F.lit(None).cast("bigint")).alias(n) for n in names
    ])

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in expected:
            return "unknown"
        return "ok" if actual[name] == expected[name] else "wrong type"

    entries = F.explode(F.array(*[
        F.struct(F.lit(n).alias("field"), F.lit(expected.get(n)).alias("expected_type"),
                 F.lit(actual.get(n)).alias("actual_type"), F.col(f"`{n}`").alias("null_count"),
                 F.lit(status(n)).alias("status")) for n in names
    ]))
    return nulls.select(entries.alias("entry")).select("entry.*")


def varint_size(value: Column) -> Column:
    """Bytes of a variable-length integer: 7 bits per byte, ten bytes for a negative one."""
    size = F.when(value < 0, 10)
    for n in range(1, 9):
        size = size.when(value < 2 ** (7 * n), n)
    return size.otherwise(9)


def _scalar_size(value: Column, kind: str) -> Column:
    if kind == "double":
        return F.lit(8)
    if kind == "bool":
        return F.lit(1)
    if kind == "string":
        length = F.octet_length(value)
        return varint_size(length) + length
    return varint_size(value.cast("bigint"))


def _field_size(field: Field) -> Column:
    """Encoded bytes of one field with its tag. A single field with the default value is left out."""
    value = F.col(f"`{field.name}`")
    tag = 1 if field.number < 16 else 2
    if field.repeated:
        sizes = F.transform(F.filter(value, lambda v: v.isNotNull()), lambda v: _scalar_size(v, field.kind) + tag)
        return F.coalesce(F.aggregate(sizes, F.lit(0), lambda total, size: total + size), F.lit(0))
    default = {"string": "", "double": 0.0, "bool": False}.get(field.kind, 0)
    return F.when(value.isNull() | (value == F.lit(default)), 0).otherwise(_scalar_size(value, field.kind) + tag)


def protobuf_size(message: str) -> Column:
    """Encoded bytes of a message whose fields are columns."""
    return reduce(add, [_field_size(f) for f in fields_of(message)], F.lit(0)).cast("bigint")


def json_size(message: str) -> Column:
    """Bytes of the compact JSON text of a message whose fields are columns."""
    return json_row_size([(f.name, f.spark_type) for f in fields_of(message)]).cast("bigint")


def payload_sizes(rows: DataFrame, message: str) -> DataFrame:
    """One row: JSON and protobuf bytes of all rows of a message, the saving, and its percentage."""
    sized = rows.select(json_size(message).alias("json_bytes"), protobuf_size(message).alias("protobuf_bytes"))
    total = sized.agg(
        F.lit(message).alias("message"),
        F.lit(len(fields_of(message))).alias("fields"),
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum("json_bytes"), F.lit(0)).alias("json_bytes"),
        F.coalesce(F.sum("protobuf_bytes"), F.lit(0)).alias("protobuf_bytes"),
    )
    saved = F.col("json_bytes") - F.col("protobuf_bytes")
    share = F.when(F.col("json_bytes") > 0, saved / F.col("json_bytes") * 100).otherwise(0.0)
    return total.withColumns({"saved": saved, "reduction_pct": share})


def round_trip(rows: DataFrame) -> DataFrame:
    """One row: rows, and how many differ after encoding to JSON and decoding with the same schema."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    decoded = F.from_json(F.to_json(row), rows.schema)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(~row.eqNullSafe(decoded)).alias("mismatches"))
