"""Near-duplicate documents: word-shingle sets whose Jaccard similarity reaches a threshold.

Method: prefixes of token combinations. Shingles have one global order, that of their hash. A set of n shingles that can
miss t of them in a partner shares one of its first t + 1 with every partner, and k of its first t + k.

1. Prefixes are extended, and a set stays only if enough of its prefix is found in other sets: of the first t + k shingles
   at most t may occur in no other set. Shingles that one set alone has are counted by set, so nothing is joined and a
   frequent shingle is summed up before it is moved. The sets that pass are extended to their whole length, which leaves
   little but near duplicates: sets that share a passage have too many shingles of their own.
2. Those left are found by combinations. Their shingles are dealt to classes by hash, more classes than similar sets
   can differ in, so that two such sets agree in a whole class, and the combination of all shingles of a class is a key.
   A frequent shingle alone is never a key, so lists of a key do not follow its frequency. (A shingle of two to eight sets
   as a key by itself, where a prefix has no frequent one, was tried and left: it ties sets together that only share a
   passage, and the clusters of step 3 ran together as the corpus grew.)
3. Sets connected by keys are a cluster, and all pairs of a cluster are verified on the whole sets, in cells of two blocks of
   sets, one task each, of neighbouring ranges of sizes. Links are counted by set and connected within the cell, so no pairs are written.

Rare shingles so serve singly, to rule sets out; the others in combinations. No list is capped. Shingles and sets are
known by 64-bit hashes; among 10^10 different sets about three pairs collide.

Sets are kept as their texts, which take half the room of their shingles, and indexes are built in slices of their keys, one after
another, so that a table full of near duplicates needs little more disk than any other. What no later step reads is dropped.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.shingles import batches, mixed, shingle_sets
from ledgerline.llm.store import dropped, small, written

BLOCK = 512  # sets on either side of a cell,
BLOCK_BYTES = 1 << 25  # and about so many bytes
#: Of all shingles of the table, a slice of an index holds a 4th (shingles) or as many keys as a 16th, a slice of cells sets of a half,
SHINGLES, KEYS, COPIES = 4, 16, 2
LEAST = 1 << 21  # and this many in any case
_TRIES = 8  # independent ways to deal shingles to classes
_U = np.uint64


def set_id(hashes: np.ndarray) -> int:
    """A signed 64-bit identity of a set."""
    return int(mixed(np.array([mixed(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64)).view(np.int64)[0])


def missing(n, num: int, den: int):
    """Of n shingles so many may be absent from a partner."""
    return (den - num) * n // den


def prefix(hashes: np.ndarray, num: int, den: int, halves: int) -> np.ndarray:
    """The first t + 1 shingles in the global order, and `halves` halves of t more."""
    t = missing(len(hashes), num, den)
    return np.sort(mixed(hashes))[: t + 1 + halves * t // 2]


def first_extension(num: int, den: int) -> int:
    """Halves of t by which the first prefix is longer: so many that it has about a quarter of a set."""
    return max(1, round(den / (den - num) / 5))


def needed(n: Column, num: int, den: int, halves: int | None) -> tuple[Column, Column]:
    """(length, found): of a prefix (None: the whole set), and how many of it occur in other sets if there is a partner, which may be shorter."""
    t = lambda m: F.floor((den - num) * m / den)
    if halves is None:
        return n, n - t(n)
    shortest = F.ceil(num * n / den)
    return F.least(n, t(n) + 1 + F.floor(halves * t(n) / 2)), F.least(n - t(n), 1 + F.floor(halves * t(shortest) / 2))


def levels(n: int, num: int, den: int) -> list[tuple[int, int]]:
    """Ranges of sizes, the last but one with n in it: a set is similar to sets of its own range and the two beside it only."""
    out = [(1, den // num)]
    while out[-1][0] <= n:
        low = out[-1][1] + 1
        out.append((low, max(low, den * low // num)))
    return out


def combination_keys(hashes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The combinations of the set's shingles by class, for partners of its own and of the next range of sizes.

    Similar sets of a level differ in d shingles at most; with more than d classes that hold shingles of a set, one is
    free of differences. Where a set fills too few, another dealing follows, in both of a pair for which none of them serves; a set
    that fills too few in all dealings goes by its level alone.
    """
    n, keys = len(hashes), []
    ranges = levels(n, num, den)
    for level in (len(ranges) - 2, len(ranges) - 1):
        d = 2 * (den - num) * ranges[level][1] // (den + num)
        classes = d + 3 + d // 8
        for i in range(_TRIES):
            dealt = mixed(hashes ^ mixed(np.array([level * _TRIES + i + 1], np.uint64)))
            of = (dealt % _U(classes)).astype(np.int64)
            order = np.argsort(of, kind="stable")
            filled, first = np.unique(of[order], return_index=True)
            sums = np.add.reduceat(mixed(dealt)[order], first)
            keys.append(mixed(sums + mixed(filled.astype(np.uint64) + _U(level << 40) + _U(i << 34))))
            if len(filled) > d:
                break
        else:
            keys.append(mixed(np.array([level], np.uint64)))
    return np.concatenate(keys)


def _profile(words: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            sets = shingle_sets(batch.column(1), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_id(s) for s in sets], pa.int64())], names=["doc_id", "n", "cid"])

    return run, "doc_id long, n long, cid long"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _keyed(keys: list[np.ndarray], cids: list[int]) -> pa.RecordBatch:
    flat = np.concatenate([*keys, np.zeros(0, np.uint64)])
    return pa.RecordBatch.from_arrays([_signed(flat), pa.array(np.repeat(np.array(cids, np.int64), [len(k) for k in keys]))], names=["key", "cid"])


def _text_prefixes(words: int, num: int, den: int, halves: int):
    """(key, cid): the prefixes of texts."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            sets = [s for s in shingle_sets(batch.column(0), words) if len(s)]
            yield _keyed([prefix(s, num, den, halves) for s in sets], [set_id(s) for s in sets])

    return run, "key long, cid long"


def _shingles(words: int, part: int, parts: int):
    """(key, cid): the shingles of sets (cid, text), one slice of them."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            yield _keyed([s[s % _U(parts) == part] for s in shingle_sets(batch.column(1), words)], batch.column(0).to_pylist())

    return run, "key long, cid long"


def _combinations(words: int, num: int, den: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            keys = [combination_keys(s, num, den).tobytes() for s in shingle_sets(batch.column(1), words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary())], names=["cid", "keys"])

    return run, "cid long, keys binary"


def _slice_of_keys(part: int, parts: int):
    """(key, cid): one slice of the keys of sets (cid, keys)."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            keys = [np.frombuffer(k, np.uint64) for k in batch.column(1).to_pylist()]
            yield _keyed([k[k % _U(parts) == part] for k in keys], batch.column(0).to_pylist())

    return run, "key long, cid long"


def _sets(words: int):
    """(cid, text): the texts that have shingles, with their set."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(stream):
            sets = shingle_sets(batch.column(0), words)
            found = pa.RecordBatch.from_arrays([pa.array([set_id(s) for s in sets], pa.int64()), batch.column(0)], names=["cid", "text"])
            yield found.filter(pa.array([len(s) > 0 for s in sets], pa.bool_()))

    return run, "cid long, text string"


def shared_sizes(sets: list[np.ndarray], columns: int = 2048) -> np.ndarray:
    """The sizes of the intersections of all pairs, from products of parts of the matrix of sets by shingles."""
    out = np.zeros((len(sets), len(sets)), np.float32)
    token, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(token, kind="stable")
    token, of = token[order], of[order]
    new = np.concatenate([[True], token[1:] != token[:-1]])
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    column, of = (np.cumsum(often) - 1)[column[keep]], of[keep]
    for a in range(0, int(often.sum()), columns):
        part = slice(*np.searchsorted(column, [a, a + columns]))
        x = np.zeros((len(sets), columns), np.float32)
        x[of[part], column[part] - a] = 1
        out += x @ x.T
    return out


def _cell(words: int, num: int, den: int, pairs: bool):
    """Links within cells: rows come by cell, (cluster, i, j, own, cid, copies, text), own being i or j.

    Per set with links: a, the set; b, the smallest set that it is connected with in the cell; links, the rows of the sets
    linked with it. With pairs, a row for each link, a < b.
    """

    def found(rows: list[tuple]) -> list[tuple]:
        texts = pa.RecordBatch.from_arrays([pa.array([r[6] for r in rows], pa.large_string())], names=["text"])
        sets = [s for part in batches([texts]) for s in shingle_sets(part.column(0), words)]
        cids, copies, own = (np.array([r[k] for r in rows], np.int64) for k in (4, 5, 3))
        size = np.array([len(s) for s in sets], np.float64)
        both = shared_sizes(sets).astype(np.float64)
        linked = den * both >= num * (size[:, None] + size[None, :] - both)
        np.fill_diagonal(linked, False)
        if rows[0][1] != rows[0][2]:  # the pairs within a block are those of its own cell
            linked &= own[:, None] != own[None, :]
        if pairs:
            return [(min(a, b), max(a, b), 1) for x, y in zip(*np.nonzero(np.triu(linked))) for a, b in [(int(cids[x]), int(cids[y]))]]
        low = cids.copy()
        while True:  # the smallest set in reach
            near = np.where(linked, low[None, :], np.iinfo(np.int64).max).min(1)
            less = np.minimum(low, near)
            if (less == low).all():
                break
            low = less
        links = linked @ copies
        return [(int(cids[k]), int(low[k]), int(links[k])) for k in np.flatnonzero(linked.any(1))]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        kinds = (pa.int64(), pa.int64(), pa.int64())

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 3, kinds)], names=["a", "b", "links"])

        for part in stream:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:3] != at:
                    if len(held) > 1:
                        yield batch(found(held))
                    at, held = row[:3], []
                held.append(row)
        if len(held) > 1:
            yield batch(found(held))

    return run, "a long, b long, links long"


class _Sets:
    """The sets of the texts of docs, their clusters and the links within. Tables are written once."""

    def __init__(self, docs: DataFrame, words: int, num: int, den: int):
        self.words, self.num, self.den = words, num, den
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        self.slim = written(texts.mapInArrow(*_profile(words)), "profile")
        self.shingles = self.slim.agg(F.sum("n")).first()[0] or 0
        known = texts.filter("doc_id IS NOT NULL")
        classes = self.slim.filter("doc_id IS NOT NULL AND n > 0").groupBy("cid").agg(
            F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.count("*").alias("copies"))
        first = first_extension(num, den)
        alone = self._alone(known.select("text").mapInArrow(*_text_prefixes(words, num, den, first)))
        classes = written(self._with_partners(classes, alone, first), "candidates")
        wanted = written(classes.select("doc_id").distinct(), "wanted")
        sets = written(known.join(small(wanted), "doc_id", "left_semi").select("text").mapInArrow(*_sets(words)), "sets")
        parts = self._slices(classes.agg(F.sum("n")).first()[0] or 0, SHINGLES)
        alone = [written(self._alone(sets.mapInArrow(*_shingles(words, part, parts))), "alone") for part in range(parts)]
        whole = functools.reduce(DataFrame.unionAll, alone).groupBy("cid").agg(F.sum("alone").alias("alone"))
        self.classes = written(self._with_partners(classes, whole, None), "classes")
        near = sets.join(small(self.classes.select("cid")), "cid", "left_semi").dropDuplicates(["cid"])
        self.sets = written(near.select("cid", "text"), "near")
        dropped(classes, wanted, sets, *alone)

    def _slices(self, keys: int, share: int) -> int:
        """In so many slices an index of so many keys is built."""
        return math.ceil(max(keys, 1) / max(self.shingles // share, LEAST))

    def _alone(self, index: DataFrame) -> DataFrame:
        """(cid, alone): how many keys of the index a set alone has."""
        alone = index.groupBy("key").agg(F.min("cid").alias("cid"), F.max("cid").alias("other")).filter("cid = other")
        return alone.groupBy("cid").agg(F.count("*").alias("alone"))

    def _with_partners(self, classes: DataFrame, alone: DataFrame, halves: int | None) -> DataFrame:
        """The classes of which enough of the prefix occurs in other sets."""
        length, found = needed(F.col("n"), self.num, self.den, halves)
        return classes.join(alone, "cid", "left").filter(length - F.coalesce("alone", F.lit(0)) >= found).drop("alone")

    def clusters(self) -> DataFrame:
        """(cid, cluster) of sets that keys connect with others."""
        held = written(self.sets.mapInArrow(*_combinations(self.words, self.num, self.den)), "keys")
        parts = self._slices((held.agg(F.sum(F.length("keys"))).first()[0] or 0) // 8, KEYS)
        ties = []
        for part in range(parts):
            keys = held.mapInArrow(*_slice_of_keys(part, parts))
            least = keys.groupBy("key").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high").select("key", "low")
            tied = keys.join(least, "key").filter("cid <> low").select(F.col("cid").alias("a"), F.col("low").alias("b"))
            ties.append(written(tied.distinct(), "ties"))
        parts = components(functools.reduce(DataFrame.unionAll, ties))
        roots = parts.select(F.col("root").alias("cid"), F.col("root").alias("cluster")).distinct()
        members = written(parts.select(F.col("node").alias("cid"), F.col("root").alias("cluster")).unionAll(roots), "clusters")
        dropped(held, *ties)
        return members

    def placed(self) -> DataFrame:
        """(cluster, i, j, own, cid, copies, n): the cells of sets. Blocks are of one range of sizes; only those of neighbouring ranges meet."""
        members = self.clusters().join(self.classes.select("cid", "copies", "n"), "cid")
        largest = members.agg(F.max("n")).first()[0] or 1
        ends = F.array(*[F.lit(high).cast("long") for _, high in levels(largest, self.num, self.den)])
        members = members.withColumn("level", F.size(F.filter(ends, lambda end: end < F.col("n"))).cast("long"))
        blocks = F.ceil(F.greatest(F.count("*") / BLOCK, 8 * F.sum("n") / BLOCK_BYTES))
        sizes = written(members.groupBy("cluster", "level").agg(blocks.alias("blocks")), "sizes")
        others = sizes.select("cluster", F.col("level").alias("beside"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
        others = others.select("cluster", F.explode(F.array(*[F.col("beside") + k for k in (-1, 0, 1)])).alias("level"), (F.shiftleft("beside", 40) + F.col("block")).alias("other"))
        others = written(others, "blocks")
        own = F.shiftleft("level", 40) + F.pmod(F.xxhash64("cid"), F.col("blocks"))
        members = members.join(small(sizes), ["cluster", "level"]).withColumn("own", own)
        return written(members.join(small(others), ["cluster", "level"]).select(
            "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cid", "copies", "n"), "placed")

    def cells(self) -> list[DataFrame]:
        """The sets of clusters, copied to the cells of their block with other blocks, in the order of cells; in slices of cells."""
        placed = self.placed()
        parts = self._slices(placed.agg(F.sum("n")).first()[0] or 0, COPIES)
        out = []
        for part in range(parts):
            rows = placed.filter(F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(parts)) == part).join(self.sets, "cid").select("cluster", "i", "j", "own", "cid", "copies", "text")
            out.append(rows.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j"))
        return out

    def linked(self, cells: list[DataFrame]) -> DataFrame:
        """What _cell says of all cells, slice by slice."""
        found = [written(rows.mapInArrow(*_cell(self.words, self.num, self.den, False)), "linked") for rows in cells]
        return functools.reduce(DataFrame.unionAll, found)

    def named(self, links: DataFrame) -> DataFrame:
        """Per row of docs: doc_id, n_shingles, component_id, cid."""
        slim, parts = self.slim, components(links)
        named = slim.join(parts, slim.cid == parts.node, "left").select("doc_id", "n", "cid", F.coalesce("root", "cid").alias("part"))
        named = written(named, "named")
        least = named.filter("n > 0").groupBy("part").agg(F.min("doc_id").alias("least"))
        own = named.filter("n = 0 OR doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "cid")
        linked = named.filter("n > 0 AND doc_id IS NOT NULL").join(least, "part").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), "cid")
        return linked.unionAll(own)


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, the smallest doc_id reachable by links of similarity num / den or more.

    Words are runs of anything but ASCII white space, with A-Z as a-z; a text of fewer than `words` words is one
    shingle. Texts that are null, empty or without words have no shingles and are linked with nothing: their
    component_id is their doc_id. Rows without doc_id link nothing and have component_id null. Repeated rows are in one
    component; rows that repeat a doc_id with other texts keep their own rows. Other columns are ignored. An empty
    table gives no rows.
    """
    sets = _Sets(docs, words, num, den)
    linked = sets.linked(sets.cells())
    dropped(sets.sets)
    return sets.named(linked.select("a", "b")).drop("cid")


def similar_sets(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> tuple[DataFrame, DataFrame]:
    """(pairs, rows). pairs: a < b, all pairs of different sets of shingles whose similarity is num / den or more, each once.

    rows: per row of docs doc_id, n_shingles, component_id as in near_duplicates, cid, the set that a and b name, and n_links:
    the number of other rows linked with it directly, those of the same set among them. Rows without doc_id or without
    words link nothing and have 0. pairs are only made if they are asked for; rows come from counts.
    """
    sets = _Sets(docs, words, num, den)
    cells = sets.cells()
    linked = sets.linked(cells)
    met = linked.groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("others"))
    linking = sets.slim.filter("doc_id IS NOT NULL AND n > 0").groupBy("cid").agg(F.count("*").alias("copies"))
    degrees = linking.join(met, "cid", "left").select("cid", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"))
    links = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("n", F.lit(0))).otherwise(0).cast("long")
    rows = sets.named(linked.select("a", "b")).join(degrees.filter("n > 0"), "cid", "left").select("doc_id", "n_shingles", "component_id", "cid", links.alias("n_links"))
    pairs = [rows.mapInArrow(*_cell(words, num, den, True)).select("a", "b") for rows in cells]
    return functools.reduce(DataFrame.unionAll, pairs), rows


def one_per_group(docs: DataFrame, words: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of docs that are the first of their group: those whose doc_id is the component's; of repeated rows one stays.

    Texts without words are in no group and all stay, as do rows without doc_id. Rows that share a doc_id stay or go together.
    """
    found = near_duplicates(docs, words, num, den)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    gone = written(gone, "gone")
    repeated = written(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    kept = docs.join(small(gone), "doc_id", "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return kept
    again = kept.join(small(repeated), "doc_id", "left_semi").select(docs.columns)
    return kept.join(small(repeated), "doc_id", "left_anti").select(docs.columns).unionAll(again.dropDuplicates(["doc_id", "text"]))
