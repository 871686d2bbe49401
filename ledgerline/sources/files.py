"""Reading and writing of files and tables."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.scalars import clean_names, formatted
from ledgerline.operators.typing import conform, infer_types
from ledgerline.session import work_dir

# The texts that a delimited file may hold for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A delimited file with a header and a known schema; a quoted empty text in a numeric column is a null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_text_columns(spark: SparkSession, path: str) -> DataFrame:
    """A delimited file with all columns as text, cleaned unique names, and null for every mark of a missing value."""
    raw = spark.read.option("header", True).csv(path)
    raw = raw.toDF(*clean_names(_header(spark, path)))
    return raw.select(*[F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in raw.columns])


def _header(spark: SparkSession, path: str) -> list[str]:
    """The column names as written; Spark would make repeated ones unique in its own way."""
    first = spark.read.option("header", False).csv(path).first()
    return [name or "" for name in first]


def write_parquet(rows: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(rows: DataFrame, path: str, order: list[str] | None = None, decimals: dict[str, int] | None = None) -> None:
    """With a header, sorted by the given keys (across files too), and some columns with a fixed count of decimals."""
    result = rows.orderBy(*order) if order else rows
    for column, digits in (decimals or {}).items():
        result = result.withColumn(column, formatted(F.col(column), digits))
    result.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One JSON object per line, nulls kept: a report (one nested row) or a stream of rows."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def load_result(spark: SparkSession, path: str, key: str = "region", format: str = "csv") -> DataFrame:
    """A stored result as (key, txn_count, score_total), whichever of the two known name pairs it uses.

    A missing file is an empty result.
    """
    schema = f"{key} string, txn_count bigint, score_total double"
    try:
        stored = spark.read.format(format).option("header", True).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

    def first_of(names: list[str], kind: str):
        present = [F.col(n).cast("double").cast(kind) for n in names if n in stored.columns]
        return F.coalesce(*present, F.lit(0).cast(kind))

    return stored.filter(F.col(key).isNotNull()).select(
        key,
        first_of(["txn_count", "transactions"], "bigint").alias("txn_count"),
        first_of(["score_total", "revenue_total"], "double").alias("score_total"),
    )


def write_stream(rows: DataFrame, path: str, checkpoint: str) -> None:
    """All rows that have arrived, as JSON lines with nulls kept. The sink logs what it has committed, so a restart repeats nothing."""
    writer = rows.writeStream.format("json").option("ignoreNullFields", False).option("path", path)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class VersionedTable:
    """A table whose every load is a folder of its own; a list of commits says which one is in force.

    A line of the list names a folder and is written once the folder is whole. Readers take the last line, so they see the
    old table or the new one, never a part and never none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> DataFrame:
        """(version, folder, row_count, schema) of all loads that were committed."""
        schema = "version bigint, folder string, row_count bigint, schema string"
        try:
            return self.spark.read.schema(schema).json(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def current(self):
        return self.versions().orderBy(F.desc("version"), "folder").first()

    def read(self) -> DataFrame:
        """The table in force; an error if nothing was ever loaded."""
        now = self.current()
        if now is None:
            raise ValueError(f"nothing was loaded into {self.path}")
        return self.spark.read.schema(StructType.fromJson(json.loads(now.schema))).parquet(f"{self.path}/{now.folder}")

    def store(self, rows: DataFrame) -> tuple[str, int]:
        """(folder, rows) of a version that is not in force yet. Rows are counted as they are written."""
        folder = f"data-{uuid.uuid4().hex}"
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{folder}")
        return folder, seen.get["n"]

    def replace(self, rows: DataFrame) -> int:
        """Put other rows in force; returns how many."""
        folder, n = self.store(rows)
        now = self.current()
        line = [(now.version + 1 if now else 1, folder, n, rows.schema.json())]
        lines = self.spark.createDataFrame(line, "version bigint, folder string, row_count bigint, schema string")
        lines.coalesce(1).write.mode("append").json(f"{self.path}/commits")
        return n


def load_table(spark: SparkSession, csv_path: str, table: str, table_path: str | None = None) -> int:
    """Load a delimited file into a typed table, replacing it; returns the number of rows.

    Names are cleaned, types inferred from all rows, and values conformed. The file is parsed once, into a table of texts; types and
    values are taken from that. The table is a view of the version in force below `table_path`, a new folder unless given.
    """
    table_path = table_path or work_dir(spark, "table")
    texts = f"{table_path.rstrip('/')}/texts-{uuid.uuid4().hex}"
    parsed = read_text_columns(spark, csv_path)
    parsed.write.parquet(texts)
    rows = spark.read.schema(parsed.schema).parquet(texts)
    types = {r.column_name: r.inferred_type for r in infer_types(rows).collect()}  # one row a column
    stored = VersionedTable(spark, table_path)
    n = stored.replace(conform(rows, types))
    stored.read().createOrReplaceTempView(table)
    return n
