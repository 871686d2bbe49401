"""Message contracts and sizes against known sizes."""

from pyspark.sql import functions as F

from ledgerline.functions import messages
from ledgerline.operators import lookups


def sizes(rows, message):
    row = messages.payload_sizes(rows, message).first()
    return row.fields, row.json_bytes, row.protobuf_bytes, round(row.reduction_pct, 1)


def test_counts_of_messages_and_fields():
    assert len(messages.MESSAGES) == 20
    assert sum(len(messages.fields_of(m)) for m in messages.MESSAGES) == 52


def test_known_sizes(spark):
    # The recorded JSON and protobuf bytes of these messages.
    assert sizes(messages.configs(spark), "MonetizationConfig") == (6, 210, 144, 31.4)
    report = spark.createDataFrame([(["region"] * 13, 173739, 13169342.0)], messages.message_schema("RegionalRevenueReport"))
    assert sizes(report, "RegionalRevenueReport") == (3, 184, 117, 36.4)
    batch = spark.createDataFrame([(["customer"] * 50,)], messages.message_schema("CustomerBatch"))
    assert sizes(batch, "CustomerBatch") == (1, 565, 500, 11.5)


def test_sizes_of_repeated_numbers_and_defaults(spark):
    ids = spark.createDataFrame([([1, 300, 0, -1],), ([],), (None,)], messages.message_schema("CustomerBatchRequest"))
    found = ids.select(messages.protobuf_size("CustomerBatchRequest").alias("n")).collect()
    assert [r.n for r in found] == [2 + 3 + 2 + 11, 0, 0]
    empty = spark.createDataFrame([("", 0)], messages.message_schema("RevenueQuery"))
    assert sizes(empty, "RevenueQuery")[1:3] == (len('{"region":"","limit":0}'), 0)


def test_varint_size(spark):
    values = [0, 127, 128, 16383, 16384, 2**31, 2**62, 2**63 - 1, -1]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select(messages.varint_size(F.col("v")).alias("n"))
    assert [r.n for r in rows.collect()] == [max(1, -(-(v % 2**64).bit_length() // 7)) for v in values]


def test_conformance(spark):
    rows = spark.createDataFrame([("r", None, "1")], "region string, transactions bigint, revenue_mean string")
    found = {r.field: (r.status, r.null_count) for r in messages.conformance(rows, "RegionRevenue").collect()}
    assert found == {"region": ("ok", 0), "transactions": ("ok", 1), "revenue_total": ("missing", None),
                     "revenue_mean": ("wrong type", 0)}


def test_configuration_lookup(spark):
    configs = messages.configs(spark)
    assert lookups.lookup(configs, "config_id", "oulad-score-proxy").first().pass_score == 40.0
    assert lookups.lookup(configs, "config_id", "other").first().status == "NOT_FOUND"


def test_message_defaults(spark):
    rows = spark.createDataFrame([(None, None)], "a bigint, b string")
    row = lookups.message_rows(rows, {"a": (F.col("a"), "bigint"), "b": (F.col("b"), "string"),
                                      "c": (F.col("a"), "double")}).first()
    assert tuple(row) == (0, "", 0.0)


def test_round_trip_keeps_odd_texts(spark):
    rows = spark.createDataFrame([('a"b\\c\né', 1e-9, None), ("", 1e300, 5)], "t string, d double, n bigint")
    assert tuple(messages.round_trip(rows).first()) == (2, 0)
