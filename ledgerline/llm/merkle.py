"""Merkle manifest of a dataset: a tree of digests for each source, a tree over the sources, and a proof for every document.

Method: time-forward processing. A node's label is its place: (tree, level, place in the level), and a digest is a
message to the label of its parent. The priority queue that orders messages by label is external: it is Spark's sorting
shuffle, which spills. It need not hold every level: SPAN levels below a node are a run of FAN ** SPAN neighbours, which one
task takes from the queue in order and passes on upwards as one message. The forward sweep so takes a pass for each SPAN
levels; its messages are kept. The reversed sweep goes through them from the root: each node's message to its children is
its proof suffix, the siblings on the way up to the root, which the children put behind their own siblings.

Places in a level come from a range-partitioned sort: each partition counts its own rows by tree, and the counts of the
partitions before (one row for each partition and tree) are added.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import small, written

FAN = 16  # children of a node
SPAN = 3  # levels between two messages
_RUN = FAN**SPAN
_SIZE = 32  # bytes of a digest


def digest(parts: list[bytes]) -> bytes:
    """sha256 of digests as concatenated hex text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def leaf(columns: list[Column]) -> Column:
    """The digest of a row: `-` for a null, else the number of UTF-8 bytes, `:` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256))


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """rows with place, from 0 in the given order within each tree, and size, the rows of the tree. tree: a column without nulls.

    rows: a written table. Equal rows are told apart by their position in it, so that no group of them is too large to split.
    """
    sorted_ = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(tree, *order, "_row").sortWithinPartitions(tree, *order, "_row")
    at = F.monotonically_increasing_id()  # the partition, then the position in it
    rows = written(sorted_.drop("_row").withColumns({"_part": F.shiftright(at, 33), "_at": at.bitwiseAND((1 << 33) - 1)}), "sorted")
    counts = rows.groupBy("_part", tree).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(tree).orderBy("_part")) - F.col("_n")
    size = F.sum("_n").over(Window.partitionBy(tree))
    counts = written(counts.select("_part", tree, (before - F.col("_first")).alias("_shift"), size.alias("size")), "counts")
    return rows.join(small(counts), ["_part", tree]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def climbed(digests: list[bytes], size: int) -> list[list[bytes]]:
    """The levels above a run of neighbours, itself included, up to SPAN of them or the root; size: of its whole level."""
    levels = [digests]
    while len(levels) <= SPAN and size > 1:
        below = levels[-1]
        levels.append([digest(below[i : i + FAN]) for i in range(0, len(below), FAN)])
        size = -(-size // FAN)
    return levels


def siblings(levels: list[list[bytes]], at: int) -> bytes:
    """The proof within a run: for each level the number of siblings on the left and on the right, and all of them."""
    out = []
    for level in levels[:-1]:
        run = at - at % FAN
        left, right = level[run:at], level[at + 1 : run + FAN]
        out.append(bytes([len(left), len(right)]) + b"".join(left) + b"".join(right))
        at //= FAN
    return b"".join(out)


def steps(proof: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """The siblings on the left and on the right, level by level."""
    at = 0
    while at < len(proof):
        m, n = proof[at], proof[at + 1]
        cut = [proof[at + 2 + i * _SIZE : at + 2 + (i + 1) * _SIZE] for i in range(m + n)]
        yield cut[:m], cut[m:]
        at += 2 + (m + n) * _SIZE


def folded(own: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    for left, right in steps(proof):
        own = digest([*left, own, *right])
    return own


def proof_digest(proof: bytes) -> bytes:
    return digest([s for left, right in steps(proof) for s in [*left, *right]])


NODE = "tree string, place long, size long, digest binary"


def _sweep(rows: DataFrame, extra: str, make: Callable, out: str) -> DataFrame:
    """What make(messages, nodes) gives for each run: nodes in the order of their labels, behind the messages to the run.

    rows: tree, run, and then place (null: a message), size, digest and the columns of `extra`.
    """
    queue = rows.repartition("tree", "run").sortWithinPartitions("tree", "run", F.asc_nulls_first("place"))
    names = [c.split()[0] for c in out.split(", ")]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, done = None, [], []

        def batch() -> pa.RecordBatch:
            kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
            columns = list(zip(*done)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(v, kinds[c.split()[1]]) for c, v in zip(out.split(", "), columns)], names=names)

        def flush() -> None:
            first = next((i for i, r in enumerate(held) if r[2] is not None), len(held))
            done.extend(make(held[:first], held[first:]))

        for part in stream:
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if row[:2] != at:
                    if held:
                        flush()
                    if len(done) >= 4096:
                        yield batch()
                        done = []
                    at, held = row[:2], []
                held.append(row)
        if held:
            flush()
        yield batch()

    columns = ["tree", "run", "place", "size", "digest", *([extra] if extra else [])]
    return queue.select(columns).mapInArrow(run, out)


def _up(messages: list[tuple], nodes: list[tuple]) -> list[tuple]:
    tree, run, _, size, _ = nodes[0]
    return [(tree, run, -(-size // _RUN), climbed([n[4] for n in nodes], size)[-1][0])]


def forward(leaves: DataFrame) -> list[DataFrame]:
    """The messages of the forward sweep: leaves (tree, place, size, digest) first, then every SPAN levels, until all trees have their root.

    A tree has one row of size 1 in the tables behind the first: its root.
    """
    tables = [leaves]
    while True:
        nodes = tables[-1] if len(tables) == 1 else tables[-1].filter("size > 1")
        if len(tables) > 1 and nodes.isEmpty():
            return tables
        rows = nodes.select("tree", F.floor(F.col("place") / _RUN).alias("run"), "place", "size", "digest")
        tables.append(written(_sweep(rows, "", _up, NODE), "level"))


def roots(tables: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    out = [t.filter("size = 1").select("tree", "digest") for t in tables[1:]]
    return out[0] if len(out) == 1 else out[0].unionAll(roots([tables[0], *tables[2:]]))


def _down(messages: list[tuple], nodes: list[tuple]) -> list[tuple]:
    suffix = messages[0][5]
    levels = climbed([n[4] for n in nodes], nodes[0][3])
    return [(n[0], n[2], siblings(levels, i) + suffix) for i, n in enumerate(nodes)]


def backward(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, run, suffix) of the runs of leaves: the siblings from there to the end. tops: (tree, suffix), what follows a tree's root."""
    found = None
    for table in reversed(tables[1:]):
        ended = table.filter("size = 1").join(tops, "tree").select("tree", F.col("place").alias("run"), "suffix")
        if found is not None:  # what the level above has sent
            nodes = table.filter("size > 1").select("tree", F.floor(F.col("place") / _RUN).alias("run"), "place", "size", "digest", F.lit(None).cast("binary").alias("suffix"))
            sent = _sweep(nodes.unionAll(_messages(found)), "suffix", _down, "tree string, run long, suffix binary")
            ended = ended.unionAll(sent)
        found = written(ended, "suffixes")
    return found


def _messages(found: DataFrame) -> DataFrame:
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("place", "long"), ("size", "long"), ("digest", "binary"))]
    return found.select("tree", "run", *none, "suffix")


def manifest(rows: DataFrame, tree: str, order: list[str], keep: list[str], other: str) -> DataFrame:
    """Per row of a written table: the columns `keep`, leaf, subroot, root, proof_sha256, folded_root, verified.

    rows: leaf, the digest; tree, a column without nulls whose trees are the leaves of one more tree, in its order; other: the
    digest from which the root is folded anew, or null for the leaf's own.
    """
    leaves = placed(rows, tree, order).withColumnsRenamed({tree: "tree", "leaf": "digest"})
    leaves = written(leaves.select("tree", "place", "size", "digest", *keep, other), "leaves")
    below = forward(leaves.select("tree", "place", "size", "digest"))
    subroots = written(roots(below).select(F.lit("").alias("all"), F.col("tree").alias("name"), "digest"), "subroots")
    names = placed(subroots, "all", ["name"]).withColumnsRenamed({"all": "tree"})
    names = written(names.select("tree", "place", "size", "digest", "name"), "sources")
    above = forward(names.select("tree", "place", "size", "digest"))
    top = roots(above).first()  # the one root
    root = bytes(top.digest) if top else b""
    ends = backward(above, names.select("tree").distinct().select("tree", F.lit(b"").alias("suffix")))
    runs = names.select("tree", F.floor(F.col("place") / _RUN).alias("run"), "place", "size", "digest", F.struct("name", F.lit(None).cast("binary").alias("suffix")).alias("more"))
    said = _messages(ends).withColumn("more", F.struct(F.lit(None).cast("string").alias("name"), "suffix")).drop("suffix")

    def named(messages: list[tuple], nodes: list[tuple]) -> list[tuple]:
        levels = climbed([n[4] for n in nodes], nodes[0][3])
        return [(n[5]["name"], siblings(levels, i) + messages[0][5]["suffix"], n[4]) for i, n in enumerate(nodes)]

    tops = written(_sweep(runs.unionAll(said), "more", named, "tree string, suffix binary, subroot binary"), "tops")
    suffixes = backward(below, tops.select("tree", "suffix"))
    subs = tops.select("tree", "subroot")
    suffixes = suffixes.join(subs, "tree").select("tree", "run", "suffix", "subroot")
    carried = F.struct(*keep, other, F.lit(None).cast("binary").alias("suffix"), F.lit(None).cast("binary").alias("subroot"))
    mine = leaves.select("tree", F.floor(F.col("place") / _RUN).alias("run"), "place", "size", "digest", carried.alias("more"))
    empty = [F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in [*keep, other]]
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("place", "long"), ("size", "long"), ("digest", "binary"))]
    theirs = suffixes.select("tree", "run", *none, F.struct(*empty, "suffix", "subroot").alias("more"))

    def proven(messages: list[tuple], nodes: list[tuple]) -> list[tuple]:
        levels, said = climbed([n[4] for n in nodes], nodes[0][3]), messages[0][5]
        out = []
        for i, n in enumerate(nodes):
            proof = siblings(levels, i) + said["suffix"]
            again = folded(n[5][other] or n[4], proof)
            out.append((*[n[5][c] for c in keep], n[4].hex(), said["subroot"].hex(), root.hex(), proof_digest(proof).hex(), again.hex(), again == root))
        return out

    kept = ", ".join(f"{c} {leaves.schema[c].dataType.simpleString().replace('bigint', 'long')}" for c in keep)
    results = ", ".join(f"{c} string" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))
    return _sweep(mine.unionAll(theirs), "more", proven, f"{kept}, {results}, verified boolean")


def audited(docs: DataFrame, every: int = 5) -> DataFrame:
    """Per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves are rows (doc_id, source, lang, n_chars, text) by source and ascending doc_id, nulls first; rows that repeat
    a doc_id go by their digests. Sources are ordered bytewise, null first and apart from the empty one. folded_root is
    folded from the proof and from the leaf of a text whose A-Z were lower-cased where the crc32 of the doc_id divides by
    `every` (a null doc_id is left alone), else from the leaf; verified: whether it is the root, as for a tampered text without
    A-Z or without value. An empty table gives no rows; other columns are ignored.
    """
    values = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string")]
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.crc32(values[0].cast("string").cast("binary")) % every == 0
    rows = docs.select(
        values[0].alias("doc_id"), F.coalesce(F.concat(F.lit("="), values[1]), F.lit("")).alias("name"), leaf(values).alias("leaf"),
        F.when(tampered, leaf([*values[:4], F.translate(values[4], capitals, capitals.lower())])).alias("other"))
    return manifest(written(rows, "rows"), "name", ["doc_id", "leaf"], ["doc_id"], "other")
