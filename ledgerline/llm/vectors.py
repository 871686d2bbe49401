"""Vectors in packed blocks, and the grid in which a stated set of query vectors meets all blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import written

#: Rows of one cell of the grid on either side; bounds what one task holds.
BLOCK_ROWS = 8192
BLOCK = "block long, n int, ids binary, body binary, more binary"


def usable(table: DataFrame, id_name: str, vector_name: str) -> DataFrame:
    """(id, vec): doubles of all rows that take part.

    Left out: rows without id or vector, vectors that are empty or hold null, NaN or an infinity, and vectors of
    another length than most have (of equally many the longer). Of rows that repeat an id the smallest vector stays.
    """
    vec = F.col(vector_name).cast("array<double>")
    rows = table.select(F.col(id_name).cast("long").alias("id"), vec.alias("vec")).filter(
        "id IS NOT NULL AND vec IS NOT NULL AND size(vec) > 0 AND NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    rows = written(rows.groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("vec") == (length.n if length else 0))


def matrix(vectors: pa.Array) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1).astype(np.float64)


def packed(rows: DataFrame, n_rows: int, by: list[Column], more: Callable[[np.ndarray, np.ndarray], bytes] | None = None) -> DataFrame:
    """(block, n, ids, body, more): rows (id, vec) range-partitioned by `by`, in that order, in blocks of BLOCK_ROWS at most.

    body: the vectors. more: further bytes of each block, from its ids and vectors; it may reorder both in place.
    """
    parts = max(1, -(-n_rows // BLOCK_ROWS))
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        made = 0

        def block(rows: pa.Table) -> pa.RecordBatch:
            ids, vecs = rows.column(0).to_numpy().copy(), matrix(rows.column(1).combine_chunks())
            added = more(ids, vecs) if more else b""
            key = rows.column(2)[0].as_py() * (1 << 32) + made
            return pa.RecordBatch.from_arrays(
                [pa.array([key], pa.int64()), pa.array([len(ids)], pa.int32()), *(pa.array([b], pa.binary()) for b in (ids.astype("<i8").tobytes(), vecs.tobytes(), added))],
                names=["block", "n", "ids", "body", "more"])

        for batch in stream:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK_ROWS:
                rows = pa.Table.from_batches(held)
                yield block(rows.slice(0, BLOCK_ROWS))
                made += 1
                held = rows.slice(BLOCK_ROWS).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return written(dealt.mapInArrow(run, BLOCK), "blocks")


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """(cell, ids, body, more), cells numbered from 0, and how many there are. Neighbouring blocks are one cell, of BLOCK_ROWS rows at most.

    A list of block keys, one for thousands of rows, passes the driver.
    """
    cells, held = [], BLOCK_ROWS
    for block, n in sorted((r.block, r.n) for r in blocks.select("block", "n").collect()):
        held = held + n if held + n <= BLOCK_ROWS else n
        cells.append((cells[-1][0] + (held == n) if cells else 0, block))
    numbers = blocks.sparkSession.createDataFrame(cells, "cell long, block long")
    own = F.sort_array(F.collect_list(F.struct("block", "ids", "body", "more")))
    merged = blocks.join(numbers, "block").groupBy("cell").agg(own.alias("own"))
    return merged.select("cell", *[F.col(f"own.{c}").alias(c) for c in ("ids", "body", "more")]), cells[-1][0] + 1 if cells else 0


def grid(queries: DataFrame, candidates: DataFrame, best: Callable, k: int, score: str = "double") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query over all cells, ties to the smaller id.

    queries, candidates: packed blocks. Every query block meets every candidate block in one task: both are copied along
    the other's numbers and joined by the cell. best(row with q_ and c_ columns) gives arrays (query_id, vec_id, score), at
    most k for each query.
    """
    (mine, m), (theirs, n) = _numbered(queries), _numbered(candidates)
    along = lambda count: F.explode(F.expr(f"sequence(0L, {count - 1}L)" if count else "cast(array() as array<bigint>)"))
    left = mine.select(F.col("cell").alias("i"), along(n).alias("j"), *[F.col(c).alias(f"q_{c}") for c in mine.columns if c != "cell"])
    right = theirs.select(along(m).alias("i"), F.col("cell").alias("j"), *[F.col(c).alias(f"c_{c}") for c in theirs.columns if c != "cell"])
    cells = max(1, m * n)
    met = left.repartition(cells, "i", "j").join(right.repartition(cells, "i", "j"), ["i", "j"])
    kind = pa.float64() if score == "double" else pa.int64()

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i in range(batch.num_rows):
                q, v, s = best({c: b"".join(batch.column(c)[i].as_py()) for c in batch.schema.names if c not in "ij"})
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, kind)], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, f"query_id long, vec_id long, score {score}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def first_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores of each query (a number), ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    query = query[order]
    starts = np.searchsorted(query, query, side="left")
    return order[np.arange(len(query)) - starts < k]
