"""Token counts of whole texts: a broadcast table of frequent pre-token lengths, worker caches for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.shingles import batches

#: Entries of the broadcast table and of each worker's cache, whatever the corpus.
TABLE = 1 << 16
CACHE = 1 << 17
PART = 1 << 16  # pieces that a task sends
LONGEST = 64  # characters of a piece that is kept
BATCH = 1 << 22  # bytes of texts that are taken apart together; a longer text is alone

_workers: dict[str, tuple[Tokenizer, dict[str, int]]] = {}


def _worker(path: str) -> tuple[Tokenizer, dict[str, int]]:
    """The tokenizer and the cache of this Python worker, kept between tasks."""
    if path not in _workers:
        _workers[path] = (Tokenizer.from_file(path), {})
    return _workers[path]


def _pieces(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The texts without nulls, what stands between their spaces, one text after another, and how many pieces each has."""
    texts = texts.cast(pa.large_string()).fill_null("")
    split = pc.split_pattern(texts, " ")
    return texts, pc.list_flatten(split), pc.list_value_length(split).to_numpy()


def _most(counts: pa.Table, n: int) -> pa.Table:
    """The n largest counts."""
    return counts if len(counts) <= n else counts.take(pa.array(np.argpartition(-counts["n"].to_numpy(), n)[:n]))


def _counted(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(piece, n) of the pieces that are frequent in a task. Of all batches so far it keeps the most frequent, a bounded number."""
    schema = pa.schema([("piece", pa.large_string()), ("n", pa.int64())])
    held, rows = [schema.empty_table()], 0

    def summed() -> pa.Table:
        both = pa.concat_tables(held).group_by("piece", use_threads=False).aggregate([("n", "sum")])
        return pa.Table.from_arrays([both["piece"], both["n_sum"]], schema=schema)

    for batch in batches(stream, BATCH):
        counts = pc.value_counts(_pieces(batch.column(0))[1])
        found = pa.Table.from_arrays([counts.field(0), counts.field(1)], schema=schema)
        held.append(found.filter(pc.less_equal(pc.utf8_length(found["piece"]), LONGEST)))
        rows += len(held[-1])
        if rows > 8 * PART:
            held, rows = [_most(summed(), 2 * PART)], 0
    best = _most(summed(), PART).cast(pa.schema([("piece", pa.string()), ("n", pa.int64())]))
    yield from best.combine_chunks().to_batches()


def frequent_lengths(texts: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the TABLE most frequent pre-tokens of all texts, by the sums of what every task finds frequent.

    A task sends PART pieces at most, so what is shuffled and collected is bounded by tasks and TABLE. A pre-token that
    is frequent nowhere may be missed; it is then encoded like any other.
    """
    often = texts.mapInArrow(_counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [r.piece for r in often.orderBy(F.desc("n"), "piece").limit(TABLE).collect()]
    tokenizer, _ = _worker(path)
    return dict(zip(pieces, map(len, tokenizer.encode_batch(pieces, add_special_tokens=False))))


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """Per row of docs: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    path: a tokenizer file whose tokens never hold a space and depend on nothing beyond one, as with a splitter that
    drops white space. Pre-tokens are the pieces of a text between spaces; the count of a text is the sum over its pieces.
    Lengths of frequent pieces come from a broadcast table of TABLE entries at most, those of others from the worker's
    cache (CACHE entries) or else from the tokenizer, all new pieces of a batch at once; each different piece of a batch is
    looked up once. No piece is shuffled but the frequent ones of each task, for the table. Special
    strings in texts count as the tokenizer's default has it. Null and empty texts have 0 bytes and 0 tokens; repeated
    rows keep their rows, a null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lengths = frequent_lengths(rows.select("text"), path)
    table = docs.sparkSession.sparkContext.broadcast((list(lengths), list(lengths.values())))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(table.value[0], pa.large_string())
        known_sizes = np.array([*table.value[1], 0], np.int64)  # the last for what is not known
        tokenizer, cache = _worker(path)
        for batch in batches(stream, BATCH):
            texts, pieces, of_text = _pieces(batch.column(1))
            pieces = pieces.dictionary_encode()
            place = pc.index_in(pieces.dictionary, value_set=known).fill_null(-1).to_numpy()
            sizes, rest = known_sizes[place], np.flatnonzero(place < 0)
            others = pieces.dictionary.take(pa.array(rest)).to_pylist()
            new = [p for p in others if p not in cache]
            fresh = {}
            for a in range(0, len(new), 4096):
                part = new[a : a + 4096]
                fresh.update(zip(part, map(len, tokenizer.encode_batch_fast(part, add_special_tokens=False))))
            sizes[rest] = [cache[p] if p in cache else fresh[p] for p in others]
            if len(cache) + len(fresh) > CACHE:
                cache.clear()
            cache.update((p, n) for p, n in fresh.items() if len(p) <= LONGEST)
            sums, ends = np.append(0, np.cumsum(sizes[pieces.indices.to_numpy()])), np.cumsum(of_text)
            counts = sums[ends] - sums[ends - of_text]
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(counts), pa.array(counts > limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
