"""Totals per key that are kept up to date over arriving files."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.joins import Hop
from ledgerline.operators.metrics import NON_NULL, finish, partial_sums, roll_up, total_of, total_parts
from ledgerline.session import work_dir


def stream_files(spark: SparkSession, path: str, schema: str, format: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """The files below a path (a folder, one file, or a pattern), as a stream."""
    if not set(path) & set("*?[{"):
        # A plain path would be taken as the root of partition folders, which a single file cannot be.
        path = path.rstrip("/")
        path = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(format).load(path)


class BatchStore:
    """What the batches of a stream have written, folded into a snapshot now and then.

    A batch writes its own folder, so a repeated batch overwrites itself. A snapshot holds all batches up to a number; it
    counts once a line naming it and the number is in the list of commits, which is written after it. A read takes the
    snapshot of the last commit and the batches after it; a crash between snapshot and commit leaves a folder that
    nothing names.
    """

    def __init__(self, spark: SparkSession, target: str, schema: str):
        self.spark, self.schema, self.target = spark, f"{schema}, batch bigint", target.rstrip("/")
        self.commits = f"{self.target}-commits"

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.target}/batch={batch}")

    def _read(self, path: str, schema: str, format: str = "parquet") -> DataFrame:
        try:
            return self.spark.read.schema(schema).format(format).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def committed(self) -> tuple[int, str | None]:
        """(number, path) of the snapshot in force; (-1, None) if there is none."""
        last = self._read(self.commits, "upto bigint, path string", "json").orderBy(F.desc("upto"), "path").first()
        return (last.upto, last.path) if last else (-1, None)

    def rows(self) -> DataFrame:
        """The snapshot in force, its rows with the number that each had, and the batches after it."""
        upto, path = self.committed()
        later = self._read(self.target, self.schema).filter(F.col("batch") > upto)
        return later if path is None else self._read(path, self.schema).unionByName(later)

    def compact(self, upto: int, fold: Callable[[DataFrame], DataFrame]) -> None:
        """Make a snapshot of the batches up to a number, all of which have to be complete. fold keeps the columns."""
        if upto <= self.committed()[0]:
            return
        path = self.snapshot(upto, fold)
        self.spark.createDataFrame([(upto, path)], "upto bigint, path string").coalesce(1).write.mode("append").json(self.commits)

    def snapshot(self, upto: int, fold: Callable[[DataFrame], DataFrame]) -> str:
        """The folder of a snapshot that no commit names yet."""
        path = f"{self.target}-snapshots/{uuid.uuid4().hex}"
        names = [c.split()[0] for c in self.schema.split(", ")]
        fold(self.rows().filter(F.col("batch") <= upto)).select(names).write.parquet(path)
        return path


def run_available(stream: DataFrame, checkpoint: str, output_mode: str,
                  write_batch: Callable[[DataFrame, int], None]) -> None:
    """Process everything that has arrived, then stop. A later run with the same checkpoint continues from there."""
    query = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write_batch)
        .start()
    )
    query.awaitTermination()


def running_totals(events: DataFrame, key: str, metric: str, scale: int | None = None) -> DataFrame:
    """Count and total per key as a stateful aggregation (non-null definition); state is one row per key.

    Spark aggregates within every task before the shuffle, so a hot key adds one row per task and batch.
    """
    total = total_of(scale, total_parts(F.col(metric), scale))
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(metric).alias("txn_count"), F.coalesce(total, F.lit(0.0)).alias("score_total"))


def stored_totals(events: DataFrame, key: str, metric: str, target: str, checkpoint: str,
                  scale: int | None = None, compact_every: int = 64) -> DataFrame:
    """Run the stateful aggregation over all arrived files; every batch writes the changed keys below `target`.

    The newest value of a key is its total. Every `compact_every` batches a snapshot takes the earlier ones in.
    """
    totals = running_totals(events, key, metric, scale)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in totals.schema.fields)
    store = BatchStore(events.sparkSession, target, schema)

    def newest(history: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("txn_count", "score_total", "batch"), "batch").alias("last")
        return history.groupBy(key).agg(last).select(key, "last.*")

    run_available(totals, checkpoint, "update", _storing(store, lambda rows: rows, newest, compact_every))
    return newest(store.rows()).drop("batch")


def _storing(store: BatchStore, make: Callable[[DataFrame], DataFrame], fold: Callable[[DataFrame], DataFrame],
             compact_every: int) -> Callable[[DataFrame, int], None]:
    """Writes a batch; a batch begins when all before it are complete, so these can be folded then."""

    def write_batch(rows: DataFrame, batch: int) -> None:
        store.write(make(rows), batch)
        if batch and batch % compact_every == 0:
            store.compact(batch - 1, fold)

    return write_batch


def _increment_store(spark: SparkSession, target: str, key: str, scale: int | None) -> tuple[BatchStore, list[str]]:
    parts = list(partial_sums(F.lit(None).cast("double"), scale))
    kinds = ", ".join(f"{c} {'double' if scale is None and c not in ('_rows', '_values') else 'bigint'}" for c in parts)
    return BatchStore(spark, target, f"{key} string, {kinds}"), parts


def increments(events: DataFrame, hops: list[Hop], key: str, metric: str, target: str, checkpoint: str,
               scale: int | None = None, compact_every: int = 64) -> None:
    """Roll every batch of events up along many-to-one joins and store its partial sums below `target`.

    This is the batch roll-up, so hot keys are summed before each join with a large table. Partial sums add up, hence
    no state is kept, a repeated batch overwrites its own folder, and earlier batches fold into a snapshot, one row a key.
    """
    store, parts = _increment_store(events.sparkSession, target, key, scale)

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in parts], F.max("batch").alias("batch"))

    def rolled(rows: DataFrame) -> DataFrame:
        parts = roll_up(rows, hops, [key], partial_sums(F.col(metric), scale))
        return parts.withColumn(key, F.col(key).cast("string"))  # as it is read

    run_available(events, checkpoint, "append", _storing(store, rolled, added, compact_every))


def once(events: DataFrame, event_id: str, time: str, delay: str) -> DataFrame:
    """Events without those delivered again: of each id only the first counts, as long as the copy comes within `delay`.

    State holds the ids of the last `delay` before the newest event. What comes later than that is dropped, a copy or not.
    """
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    return timed.dropDuplicatesWithinWatermark([event_id]).drop("_time")


def totals_of(spark: SparkSession, target: str, key: str, scale: int | None = None,
              definition: str = NON_NULL) -> DataFrame:
    """The totals so far: the sum of the snapshot in force and of the increments after it."""
    store, parts = _increment_store(spark, target, key, scale)
    merged = store.rows().groupBy(key).agg(*[F.sum(c).alias(c) for c in parts])
    return finish(merged, key, definition, scale)


def streamed_revenue(events: DataFrame, hops: list[Hop], key: str, metric: str, scale: int | None = None,
                     target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Regional totals of a stream, like the batch result. New folders are used unless given."""
    spark = events.sparkSession
    target = target or work_dir(spark, "totals")
    increments(events, hops, key, metric, target, checkpoint or work_dir(spark, "checkpoint"), scale)
    return totals_of(spark, target, key, scale)
