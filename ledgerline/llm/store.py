"""Tables written to the folder the cluster shares, so that later jobs read them instead of computing them again."""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where intermediate tables go when the session names no shared folder, as in tests on one machine.
LOCAL_FOLDER = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset (one machine, tests) a folder of this module's own is set."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    os.makedirs(LOCAL_FOLDER, exist_ok=True)
    return f"file://{LOCAL_FOLDER}"


_WRITTEN = re.compile(r"\w+-[0-9a-f]{32}")
#: Shuffle files go when the rows that came of them are written, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """The rows of df, written once to the shared folder and read back: its lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Removes written tables that nothing will read again; other files stay."""
    for table in tables:
        spark = table.sparkSession
        paths = {file.rpartition("/")[0] for file in table.inputFiles()}
        for path in paths:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if _WRITTEN.fullmatch(place.getName()):
                place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Rows of numbers that a broadcast may have; beyond it the join shuffles both sides.
BROADCAST_ROWS = 1 << 20


def small(keys: DataFrame) -> DataFrame:
    """keys (a written table of a few numbers a row) with a broadcast hint if a count shows that they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
