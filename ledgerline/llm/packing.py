"""Packing along a space-filling curve: neighbouring documents share sequences."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.shingles import batches, mixed
from ledgerline.llm.store import written

DIMS, BITS = 4, 8  # of the curve: keys of 32 bits
CACHE = 1 << 17  # pieces a Python worker keeps the ids of

#: How the byte-level splitter cuts text: a fixed pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space by any definition a splitter may have.
_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace()]
_workers: dict[str, "Ids"] = {}


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Ids:
    """Token ids of texts as the library gives them, with a cache of pieces.

    A byte-level splitter never joins characters over a single space between two other characters: such a space begins a
    new piece, whatever stands before it. So a text is the sequence of its pieces at those spaces. New pieces are merged by
    the same vocabulary, whose ids are in the order of their merges, in a library that is faster on short strings; texts that
    hold white space next to a space, or a special string, are encoded whole by the tokenizer itself.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        self.merger = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)  # bytes of each token
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]
        self.cache: dict[str, bytes] = {}

    def separable(self, text: str) -> bool:
        """Whether all spaces stand between two characters that are no white space, and no special string is in the text."""
        if not text or text[0].isspace() or text[-1].isspace() or any(s in text for s in self.special):
            return False
        return not any(" " + c in text or c + " " in text for c in _SPACES if c in text)

    def merged(self, text: str) -> np.ndarray:
        return np.array(self.merger.encode_ordinary(text), self.width)

    def pieces(self, new: list[str]) -> dict[str, bytes]:
        """The ids of each piece with a space before it: all pieces are merged as one text, then cut where pieces end."""
        ids = self.merged("".join([" " + p for p in new]))
        ends = np.cumsum([1 + len(p.encode()) for p in new])
        cuts = (np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1) * self.width.itemsize
        raw, cuts = ids.tobytes(), cuts.tolist()
        return {p: raw[a:b] for p, a, b in zip(new, [0, *cuts], cuts)}

    def of(self, texts: list[str]) -> list[bytes]:
        split = [t.split(" ") if self.separable(t) else None for t in texts]
        cache = self.cache
        missed = {p for own in split if own for p in own[1:] if p not in cache}
        if len(cache) + len(missed) > CACHE:
            cache.clear()
            missed = {p for own in split if own for p in own[1:]}
        if missed:
            cache.update(self.pieces(list(missed)))
        return [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.width).tobytes() if own is None
            else self.merged(own[0]).tobytes() + b"".join([cache[p] for p in own[1:]])
            for text, own in zip(texts, split)
        ]


def worker(path: str) -> Ids:
    if path not in _workers:
        _workers[path] = Ids(path)
    return _workers[path]


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of points on a grid of 2^bits cells a side: Gray-code rotations, all points at once."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, 0) ^ swap
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def directions(size: int, seed: int) -> np.ndarray:
    """A fixed direction of DIMS signs-and-sizes for each hashed token id."""
    ids = np.arange(size, dtype=np.uint64)[:, None] * np.uint64(DIMS) + np.arange(DIMS, dtype=np.uint64)
    return (mixed(ids + np.uint64(seed)) >> np.uint64(11)).astype(np.float64) / 2.0**52 - 1.0


def pack(docs: DataFrame, path: str, length: int = 1024, end: int = 0, seed: int = 11) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length, padded.

    A document is the ids of its whole text (null: empty) and then `end`. Its hashed bag of tokens is projected to DIMS
    dimensions by fixed random directions and gets the Hilbert key of its cell; documents are range-sorted by
    (key, doc_id) and laid end to end along the curve, cut every `length` ids. So all sequences but the last of all
    are full; that one is padded to `length`, unless its length is a power of two. Token ids are computed once and
    written to the shared folder; the sort and the running sums see only numbers of each document, so that a third of all
    documents with one key is dealt over ranges by doc_id. Repeated rows are separate documents. Other columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    width = Ids(path).width

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker(path)
        table = None
        for batch in batches(stream):
            tail = np.array([end], ids.width).tobytes()
            encoded = [b + tail for b in ids.of([t or "" for t in batch.column(2).to_pylist()])]
            counts = np.array([len(b) // ids.width.itemsize for b in encoded], np.int64)
            flat = np.frombuffer(b"".join(encoded), ids.width)
            if table is None:
                table = directions(ids.tokenizer.get_vocab_size(), seed).astype(np.float32)
            sums = np.add.reduceat(table[flat], np.cumsum(counts) - counts, axis=0)
            place = 1 / (1 + np.exp(-2 * sums / np.sqrt(counts)[:, None]))  # spread over (0, 1)
            cells = np.minimum((place * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hilbert_key(cells, BITS)), pa.array(counts), pa.array(encoded, pa.binary())],
                                             names=["row", "doc_id", "key", "n", "ids"])

    tokens = written(rows.mapInArrow(encode, "row long, doc_id long, key long, n long, ids binary"), "tokens")
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ordered = tokens.select("key", "doc_id", "row", "n").repartitionByRange(int(parts), "key", "doc_id", "row").sortWithinPartitions("key", "doc_id", "row")

    def run_sums(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in stream:
            n = batch.column(1).to_numpy()
            sums = np.cumsum(n) + before
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sums - n), pa.array(sums)], names=["row", "part", "begin", "stop"])
            before = int(sums[-1]) if len(sums) else before

    placed = written(ordered.select("row", "n", F.spark_partition_id().cast("long").alias("part")).mapInArrow(
        run_sums, "row long, part long, begin long, stop long"), "placed")
    bases = placed.groupBy("part").agg(F.max("stop").alias("size"))  # one row for each range
    bases = bases.withColumn("base", F.sum("size").over(Window.orderBy("part")) - F.col("size"))
    total = bases.agg(F.sum("size")).first()[0] or 0
    positions = placed.join(bases, "part").select("row", (F.col("base") + F.col("begin")).alias("at"))
    joined = tokens.join(positions, "row").select("doc_id", "at", "ids")

    def cut(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out: list[tuple[int, ...]] = []
            for doc, at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.frombuffer(ids.as_buffer(), width).astype("<u4")
                edges = [0, *range(length - at % length, len(ids), length), len(ids)]
                out += [(doc, a, b - a, zlib.crc32(ids[a:b]), len(ids), (at + a) // length, (at + a) % length) for a, b in zip(edges, edges[1:])]
            columns = list(zip(*out)) or [[]] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    pieces = joined.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    rest = total % length
    last = rest if rest & (rest - 1) == 0 else length  # a power of two needs no padding
    final = (F.col("sequence_id") == total // length) & F.lit(rest > 0)
    return pieces.withColumns({"sequence_length": F.when(final, rest).otherwise(length).cast("long"), "padded": F.when(final, last).otherwise(length).cast("long")})


def vocabulary(name: str) -> str:
    """The path of a public tokenizer file."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
