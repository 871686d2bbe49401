"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that starts anywhere else are found and removed.

Method: a logarithmic family of sparse suffix arrays. Not every suffix is indexed, but those that every string of LENGTH
bytes is sure to hold: the strings (windows) of a text are cut into runs of neighbours that share their least hash of SEED
bytes, so that equal windows lie in runs with an equal seed wherever they are. A suffix array is a table of seeds in order,
one row each, bucketed by seed; the order is that of the seed's 64-bit hash, which keeps equal beginnings together, all that
a merge scan for matches asks of an order, and deals frequent beginnings out evenly. A new batch gets its array and is
merge-scanned against every existing level (a sort-merge join of two bucketed tables: nothing is shuffled); while the two
newest levels are of equal size they are merged into one (a full outer sort-merge join), so that each entry is rewritten
about log2(batches) times.

An exact check follows. Runs that are equal as a whole are removed without a look at their bytes. Where a seed has different runs,
their windows are compared by 64-bit hashes within the seed, each different run once; seeds with too many of them for one
task are spread by window instead.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shingles import batches, flat_bytes, mixed
from ledgerline.llm.store import BROADCAST_ROWS, shared_folder, small, written

LENGTH = 200  # bytes of a string that must not repeat
SEED = 64  # bytes of the beginnings that are indexed
CROWD = 4096  # different runs of a seed that one task compares
_PIECE = 1 << 19  # windows looked at together
_U = np.uint64
_BASE = _U(0xD6E8FEB86659FD93)  # odd, so that its powers have inverses modulo 2^64
_BYTE = np.random.default_rng(813).integers(1, 1 << 63, 256, dtype=np.uint64)


class Rolling:
    """64-bit hashes of substrings, from sums over all bytes before."""

    def __init__(self, flat: np.ndarray):
        powers, inverse = (np.full(len(flat) + 1, b, np.uint64) for b in (_BASE, _U(pow(int(_BASE), -1, 1 << 64))))
        powers[0] = inverse[0] = 1
        self._inverse = np.cumprod(inverse, dtype=np.uint64)
        self._sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(_BYTE[flat] * np.cumprod(powers, dtype=np.uint64)[:-1], out=self._sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mixed((self._sums[start + length] - self._sums[start]) * self._inverse[start] + np.asarray(length, np.uint64))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, from running minima within blocks of that width."""
    m = len(values) - width + 1
    blocks = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:m], left[width - 1 : width - 1 + m])


def runs(flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, seed, run, again): the runs of windows with one seed, piece by piece.

    bounds: where each text begins, with the end of the last. run: a hash of all bytes of the run. again: whether the seed itself
    repeats so that windows of the run can be equal.
    """
    for at in range(0, len(flat) - LENGTH + 1, _PIECE):
        part = flat[at : at + _PIECE + LENGTH - 1]
        m = len(part) - LENGTH + 1
        rolling = Rolling(part)
        seeds = rolling.of(np.arange(len(part) - SEED + 1), SEED)
        least = _least(seeds, LENGTH - SEED + 1)
        text = np.searchsorted(bounds, np.arange(m) + at, side="right") - 1
        inside = bounds[text + 1] - at - np.arange(m) >= LENGTH
        begins = inside.copy()
        begins[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
        start = np.flatnonzero(begins)
        windows = np.add.reduceat(inside, start).astype(np.int64) if len(start) else start
        repeats = np.concatenate([[0], np.cumsum(seeds[:m] == least)])
        again = repeats[start + np.maximum(windows - 1, 0)] > repeats[start]
        yield text[start], start + at - bounds[text[start]], windows, least[start], rolling.of(start, windows + LENGTH - 1), again


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


ENTRY = "a long, b long, start long, windows long, seed long, run long, again boolean"


def _entries(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(stream):
        a, b = (batch.column(i).to_numpy() for i in (0, 1))
        for text, start, windows, seed, run, again in runs(*flat_bytes(batch.column(2))):
            yield pa.RecordBatch.from_arrays([pa.array(a[text]), pa.array(b[text]), pa.array(start), pa.array(windows), _signed(seed), _signed(run), pa.array(again)],
                                             names=[c.split()[0] for c in ENTRY.split(", ")])


class SuffixIndex:
    """Levels of suffix arrays: (seed, n, low, high), the runs of a seed and the least and largest of their hashes.

    Tables lie in a database of their own in the shared folder; merged levels are dropped.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"suffixes_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{shared_folder(spark)}/{self.name}'")
        self.levels: list[tuple[int, str]] = []  # size in batches, table

    def _stored(self, rows: DataFrame) -> str:
        table = f"{self.name}.level_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "seed").sortBy("seed").option("compression", "zstd").saveAsTable(table)
        return table

    def add(self, entries: DataFrame) -> DataFrame:
        """(seed, mixed) of the seeds of a new batch that occur again in it or in what was there: whether their runs differ."""
        once = entries.select("seed", "run", F.when(F.col("again"), F.col("run").bitwiseXOR(F.lit(1))).otherwise(F.col("run")).alias("other"))
        sums = [F.count("*").alias("n"), F.min(F.least("run", "other")).alias("low"), F.max(F.greatest("run", "other")).alias("high")]
        array = self._stored(once.repartition(self.buckets, "seed").groupBy("seed").agg(*sums))
        new = self.spark.table(array)
        found = [new.filter("n > 1 OR low <> high").selectExpr("seed", "low <> high AS mixed")]
        for _, level in self.levels:
            x, y = new.alias("x"), self.spark.table(level).alias("y")
            found.append(x.join(y, "seed").selectExpr("seed", "x.low <> y.low OR x.high <> y.high OR x.low <> x.high AS mixed"))
        out = written(reduce(DataFrame.unionAll, found), "found")
        self.levels.append((1, array))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (m, older), (n, newer) = self.levels[-2:]
            x, y = self.spark.table(older).alias("x"), self.spark.table(newer).alias("y")
            both = x.join(y, "seed", "full_outer").select(
                "seed", (F.coalesce("x.n", F.lit(0)) + F.coalesce("y.n", F.lit(0))).alias("n"), F.least("x.low", "y.low").alias("low"), F.greatest("x.high", "y.high").alias("high"))
            self.levels[-2:] = [(m + n, self._stored(both))]
            for table in (older, newer):
                self.spark.sql(f"DROP TABLE {table}")
        return out

    def drop(self) -> None:
        """Removes the levels; what add has given stays."""
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")


def _with_lists(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """texts (a, b, text) with the lists (a, b, list, n) of their row; broadcast if all of them together are few."""
    total = lists.agg(F.sum("n")).first()[0] or 0
    return texts.join(F.broadcast(lists.drop("n")) if total <= BROADCAST_ROWS else lists.drop("n"), ["a", "b"], how)


CONTEXT = "seed long, single boolean, a long, b long, start long, bytes binary"


def _contexts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs listed for each text."""
    for batch in stream:
        for a, b, wanted, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            body = text.encode()
            rows = [(w["seed"], w["single"], a, b, w["start"], body[w["start"] : w["start"] + w["windows"] + LENGTH - 1]) for w in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                                             names=[c.split()[0] for c in CONTEXT.split(", ")])


def _windows(bodies: list[bytes], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which, at, hash) of all windows of the bodies; equal hashes: equal windows of one seed."""
    sizes = np.array([len(b) for b in bodies])
    counts = sizes - LENGTH + 1
    which = np.repeat(np.arange(len(bodies)), counts)
    at = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.cumsum(sizes) - sizes
    hashes = Rolling(np.frombuffer(b"".join(bodies), np.uint8)).of(first[which] + at, LENGTH)
    return which, at, mixed(hashes ^ mixed(seeds.view(np.uint64))[which])


def _compared(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, start, windows) of the windows of single runs that are in another run of the seed, or twice in their own.

    Rows come in the order of seeds; as many seeds as fit a piece are looked at together.
    """

    def repeated(rows: list[tuple]) -> pa.RecordBatch:
        which, at, hashes = _windows([r[5] for r in rows], np.array([r[0] for r in rows], np.int64))
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        twice = np.zeros(len(hashes), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        twice &= np.array([r[1] for r in rows])[which]
        begins = twice.copy()
        begins[1:] &= ~twice[:-1] | (which[1:] != which[:-1])
        first = np.flatnonzero(begins)
        n = np.add.reduceat(twice, first) if len(first) else first
        a, b, start = (np.array([r[i] for r in rows], np.int64)[which[first]] for i in (2, 3, 4))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(start + at[first]), pa.array(n.astype(np.int64))], names=["a", "b", "start", "windows"])

    held, size = [], 0
    for batch in stream:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and size >= _PIECE and row[0] != held[-1][0]:
                yield repeated(held)
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield repeated(held)


def _spread(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of the runs as a row."""
    for batch in stream:
        seeds, single, a, b, start = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        bodies = batch.column(5).to_pylist()
        for i in range(0, len(bodies), 64):
            which, at, hashes = _windows(bodies[i : i + 64], seeds[i : i + 64])
            which = which + i
            yield pa.RecordBatch.from_arrays([pa.array(seeds[which]), _signed(hashes), pa.array(single[which].astype(bool)), pa.array(a[which]), pa.array(b[which]), pa.array(start[which] + at)],
                                             names=["seed", "window", "single", "a", "b", "start"])


def _singles(texts: DataFrame, classes: DataFrame, crowd: int) -> DataFrame:
    """(a, b, start, windows) repeated in runs that occur once. classes: the different runs of seeds with several, and where one is."""
    per = F.collect_list(F.struct("seed", (F.col("n") == 1).alias("single"), "at.start", "at.windows"))
    lists = classes.groupBy("at.a", "at.b").agg(per.alias("wanted"), F.count("*").alias("n"))
    rows = _with_lists(texts, written(lists, "wanted"), "inner").select("a", "b", "wanted", "text").mapInArrow(_contexts, CONTEXT)
    rows = written(rows, "contexts")
    crowded = small(written(classes.groupBy("seed").count().filter(F.col("count") > crowd).select("seed"), "crowded"))
    few, many = rows.join(crowded, "seed", "left_anti"), rows.join(crowded, "seed", "left_semi")
    columns = [c.split()[0] for c in CONTEXT.split(", ")]
    compared = few.select(columns).repartition("seed").sortWithinPartitions("seed").mapInArrow(_compared, "a long, b long, start long, windows long")
    if many.isEmpty():
        return compared
    spread = written(many.select(columns).mapInArrow(_spread, "seed long, window long, single boolean, a long, b long, start long"), "windows")
    twice = written(spread.groupBy("seed", "window").count().filter("count > 1").select("seed", "window"), "twice")
    return compared.unionAll(spread.filter("single").join(twice, ["seed", "window"], "left_semi").select("a", "b", "start", F.lit(1).cast("long").alias("windows")))


def _merged(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes that listed windows cover, as begin and end of every stretch."""
    for batch in stream:
        out = []
        for marks in batch.column(2).to_pylist():
            start = np.array([m["start"] for m in marks], np.int64)
            end = start + np.array([m["windows"] for m in marks], np.int64) + LENGTH - 1
            order = np.argsort(start, kind="stable")
            start, reach = start[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], start[1:] > reach[:-1]])
            out.append(np.stack([start[new], np.append(reach[:-1][new[1:]], reach[-1])], 1).ravel().tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int64())), pa.array([len(x) // 2 for x in out], pa.int64())], names=["a", "b", "cut", "n"])


def repeats(texts: DataFrame, batches_: int = 4, crowd: int = CROWD) -> DataFrame:
    """(a, b, cut, n): for the texts (a, b, text) with repeated windows, begin and end of the n stretches they cover, one after another."""
    entries = written(texts.mapInArrow(_entries, ENTRY).withColumn("batch", F.spark_partition_id() % batches_), "entries")
    index = SuffixIndex(texts.sparkSession)
    found = [index.add(entries.filter(F.col("batch") == i)) for i in range(batches_)]
    seeds = written(reduce(DataFrame.unionAll, found).groupBy("seed").agg(F.max("mixed").alias("mixed")), "seeds")
    hits = written(entries.join(seeds, "seed").select("a", "b", "start", "windows", "seed", "run", "again", "mixed"), "hits")
    differ = hits.filter("mixed")
    at = F.min(F.struct("a", "b", "start", "windows")).alias("at")
    classes = written(differ.groupBy("seed", "run").agg(F.count("*").alias("n"), at), "classes")
    place = ["a", "b", "start", "windows"]
    whole = differ.join(classes.filter("n > 1").select("seed", "run"), ["seed", "run"], "left_semi")
    marks = hits.filter("NOT mixed").select(place).unionAll(whole.select(place)).unionAll(_singles(texts, classes, crowd)).distinct()
    index.drop()
    return written(marks.groupBy("a", "b").agg(F.collect_list(F.struct("start", "windows")).alias("marks")).mapInArrow(_merged, "a long, b long, cut array<long>, n long"), "cuts")


def deduped(docs: DataFrame, batches_: int = 4, crowd: int = CROWD) -> DataFrame:
    """Per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Texts are UTF-8 bytes, null is empty; a window is LENGTH bytes of one text. Every byte of a window that starts anywhere else
    too is removed: in another row, also one that repeats doc_id and text, or elsewhere in the same text, overlaps included. n_spans:
    the stretches removed; spans: their begins and ends; kept_sha256: of the bytes that stay. Shorter texts keep everything. A null
    doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # A row is known by its doc_id and text: rows that repeat both have the same bytes removed.
    rows = rows.select("doc_id", F.coalesce("doc_id", F.lit(-1).cast("long")).alias("a"), F.xxhash64("text").alias("b"), "text")
    cuts = repeats(rows.filter(F.octet_length("text") >= LENGTH).select("a", "b", "text"), batches_, crowd)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            out = []
            for doc_id, cut, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                body, cut = text.encode(), cut or []
                left, at = hashlib.sha256(), 0
                for begin, end in zip(cut[::2], cut[1::2]):
                    left.update(body[at:begin])
                    at = end
                left.update(body[at:])
                out.append((doc_id, len(body), sum(cut[1::2]) - sum(cut[::2]), len(cut) // 2, left.hexdigest(), cut))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 6, kinds)],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    joined = _with_lists(rows, cuts, "left").select("doc_id", "cut", "text")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>")
