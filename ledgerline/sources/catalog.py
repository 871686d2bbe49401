"""Tables by logical name and role."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT, ENTITY, LOOKUP, RAW = "Event", "Entity", "Lookup", "Raw"


@dataclass(frozen=True)
class Table:
    """Where a table lies, what it is for, and its schema (so that no read has to infer one)."""

    name: str
    role: str
    schema: str
    file: str
    format: str = "parquet"


class Catalog:
    """A set of tables below one folder."""

    def __init__(self, root: str, tables: list[Table]):
        self.root = root.rstrip("/")
        self.tables = {t.name: t for t in tables}

    def path_for(self, name: str) -> str:
        return f"{self.root}/{self.tables[name].file}"

    def role(self, name: str) -> str:
        return self.tables[name].role

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        table = self.tables[name]
        reader = spark.read.schema(table.schema)
        if table.format == "csv":
            reader = reader.option("header", True)
        return reader.format(table.format).load(self.path_for(name))

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Make every table a temporary view, for ad-hoc SQL."""
        for name in self.tables:
            self.read(spark, name).createOrReplaceTempView(prefix + name)
        return [prefix + name for name in self.tables]

    def sizes(self, spark: SparkSession, name: str) -> DataFrame:
        """Number and total bytes of the files of a table; lists files, reads none."""
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path_for(name))
        return files.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
        )


def table_counts(spark: SparkSession, catalog: Catalog) -> DataFrame:
    """(table_name, role, row_count) for every table; the count of an unreadable one is null."""
    parts = []
    for name, table in catalog.tables.items():
        try:
            counted = catalog.read(spark, name).agg(F.count(F.lit(1)).alias("row_count"))
        except AnalysisException:
            counted = spark.range(1).select(F.lit(None).cast("bigint").alias("row_count"))
        parts.append(counted.select(F.lit(name).alias("table_name"), F.lit(table.role).alias("role"), "row_count"))
    listing = parts[0]
    for part in parts[1:]:
        listing = listing.unionByName(part)
    return listing


def run_sql(spark: SparkSession, text: str, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over the registered views, with named parameters (`:name`)."""
    return spark.sql(text, args=args or {})


def read_database(spark: SparkSession, url: str, query: str, column: str | None = None,
                  bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str) -> DataFrame:
    """A query result of a database over JDBC, read in `partitions` ranges of `column` when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, **options)
    if column and bounds:
        reader = reader.options(dbtable=f"({query}) AS source", partitionColumn=column, lowerBound=bounds[0],
                                upperBound=bounds[1], numPartitions=partitions)
    else:
        reader = reader.option("query", query)
    return reader.load()
