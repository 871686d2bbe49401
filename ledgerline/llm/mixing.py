"""Mixing sources to target weights by temperature, realised as budgeted block permutations."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.packing import worker
from ledgerline.llm.shingles import batches
from ledgerline.llm.store import written

BLOCKS = 1 << 12  # in which a source's documents are permuted


@dataclass(frozen=True)
class Target:
    """What the exponent is bisected for: the entropy of the weights (nats), or the most passes over any source."""

    entropy: float | None = None
    passes: float | None = None


def tempered(tokens: list[float], exponent: float) -> list[float]:
    """Normalised token shares raised to the exponent: 1 keeps them, 0 makes them equal."""
    top = max(tokens)
    raised = [(t / top) ** exponent for t in tokens]
    return [r / sum(raised) for r in raised]


def most_passes(tokens: list[float], weights: list[float]) -> float:
    """Passes over the most repeated source, if the budget is such that no source gets less than one."""
    ratios = [w / t for w, t in zip(weights, tokens)]
    return max(ratios) / min(ratios)


def bisected(tokens: list[float], target: Target) -> float:
    """The exponent in [0, 1] that meets the target, or the nearer end where none does. Entropy falls and passes fall as it rises."""
    def above(exponent: float) -> bool:
        weights = tempered(tokens, exponent)
        if target.entropy is not None:
            return -sum(w * math.log(w) for w in weights if w > 0) > target.entropy
        return most_passes(tokens, weights) > target.passes

    low, high = 0.0, 1.0
    if not above(low):
        return low
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if above(middle) else (low, middle)
    return high


def estimated_tokens(text: Column) -> Column:
    """Four UTF-8 bytes count as a token; every document has one at least."""
    return F.greatest(F.ceil(F.octet_length(F.coalesce(text.cast("string"), F.lit(""))) / 4), F.lit(1)).cast("long")


def _counted(path: str):
    """Of rows (name, block, place, text) the tokens of each text; every document has one at least."""

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = worker(path)
        for batch in batches(stream):
            found = ids.of([t or "" for t in batch.column(3).to_pylist()])
            n = np.maximum(np.array([len(i) for i in found], np.int64) // ids.width.itemsize, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n)], names=["__name", "__block", "__place", "__n"])

    return run


def plan(docs: DataFrame, target: Target, tokens: Column | str, budget: int | None = None, seed: int = 5) -> tuple[DataFrame, DataFrame]:
    """(sources, rows): what each source gets; and each row of docs, as a struct, with its source, block and place.

    sources: source, tokens, share, weight, quota, full (whole passes), cut (the last place of the part pass).
    The decision of a row needs its own hash and its source's row only: a source's documents are permuted by a hash of
    (seed, doc_id, text), whose leading bits are the block; the quota of the last, partial pass takes whole blocks up to one, and of that
    one the places up to the cut. Token sums go by (source, block), so a source with a third of all rows is BLOCKS
    groups, and only the places of the cut blocks are ordered.
    """
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 1)
    shift = 63 - (BLOCKS.bit_length() - 1)
    count = tokens if isinstance(tokens, Column) else F.lit(None).cast("long")
    rows = docs.select(F.struct(*docs.columns).alias("row"), place.alias("__place"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__name"), count.alias("__n"))
    rows = rows.withColumn("__block", F.shiftright("__place", shift))
    if isinstance(tokens, str):  # counted once, since the numbers are read twice
        texts = rows.select("__name", "__block", "__place", F.col("row.text").cast("string").alias("text"))
        light = written(texts.mapInArrow(_counted(tokens), "__name string, __block long, __place long, __n long"), "light")
    else:
        light = rows.select("__name", "__block", "__place", "__n")
    blocks = light.groupBy("__name", "__block").agg(F.sum("__n").alias("n"))
    blocks = written(blocks, "blocks")
    totals = blocks.groupBy("__name").agg(F.sum("n").alias("tokens"))
    facts = totals.groupBy().agg(F.sort_array(F.collect_list(F.struct("__name", "tokens"))).alias("all")).first()
    names, counts = [r["__name"] for r in facts["all"]], [float(r["tokens"]) for r in facts["all"]]  # one row for each source
    weights = tempered(counts, bisected(counts, target)) if counts else []
    whole = max((t / w for t, w in zip(counts, weights)), default=0.0)
    spent = float(budget) if budget is not None else whole  # by default no source gets less than one pass
    table = [(n, int(t), t / sum(counts), w, int(round(w * spent)), int(w * spent * (1 + 1e-12) // t)) for n, t, w in zip(names, counts, weights)]
    sources = docs.sparkSession.createDataFrame(table, "name string, tokens long, share double, weight double, quota long, full long")
    sources = sources.withColumn("left", F.greatest(F.col("quota") - F.col("full") * F.col("tokens"), F.lit(0)))
    run = F.sum("n").over(Window.partitionBy("__name").orderBy("__block"))
    cuts = blocks.withColumn("before", run - F.col("n")).join(sources.select("name", "left"), F.col("__name") == F.col("name"))
    cuts = cuts.filter("before <= left AND left < before + n").select("__name", "__block", (F.col("left") - F.col("before")).alias("rest"))
    inside = light.join(cuts, ["__name", "__block"]).groupBy("__name", "__block", "__place", "rest").agg(F.sum("__n").alias("__n"))
    inside = inside.withColumn("run", F.sum("__n").over(Window.partitionBy("__name").orderBy("__place")))
    last = inside.groupBy("__name").agg(F.max(F.when(F.col("run") <= F.col("rest"), F.col("__place"))).alias("last"), F.min("__block").alias("block"))
    last = last.select(F.col("__name").alias("name"), F.coalesce("last", F.shiftleft(F.col("block").cast("long"), shift) - 1).alias("cut"))
    sources = sources.join(last, "name", "left").withColumn("cut", F.coalesce("cut", F.lit(-1)))  # no cut block: nothing is left
    return written(sources, "sources"), rows.drop("__n")


def copies(docs: DataFrame, target: Target, tokens: Column | str | None = None, budget: int | None = None, seed: int = 5) -> tuple[DataFrame, DataFrame]:
    """(sources, rows): docs with __weight, __copies, how often the mixture has each row, and __block, __place, its permutation.

    Token shares of the sources are raised to an exponent, bisected to meet the target, and normalised; weights times
    the budget are the quotas. A quota takes whole passes over its source and then a part of one, in permuted order.
    Without a budget, the budget is the smallest that gives every source one whole pass, so no document is lost.
    tokens: the path of a byte-level tokenizer file, which counts each text, or a positive number for each row; by default
    estimated_tokens, which differs by language and kind of text. A null source is a source of its own, named
    empty. Null ids and texts are rows like others; rows that repeat id and text have one place and share their
    fate. An empty table gives no rows. Columns of docs that are named like an added one give way to it.
    """
    sources, found = _copied(docs, target, tokens, budget, seed)
    own = [c for c in docs.columns if c not in _ADDED]
    return sources, found.select(*[F.col("row")[c].alias(c) for c in own], *_ADDED)


_ADDED = ["__weight", "__copies", "__block", "__place"]


def _copied(docs: DataFrame, target: Target, tokens: Column | str | None, budget: int | None, seed: int) -> tuple[DataFrame, DataFrame]:
    """(sources, rows): the rows of docs as structs, with the columns that copies adds."""
    sources, rows = plan(docs, target, tokens if tokens is not None else estimated_tokens(F.col("text")), budget, seed)
    per = sources.select(F.col("name").alias("__name"), F.col("weight").alias("__weight"), F.col("full").alias("__full"), F.col("cut").alias("__cut"))
    found = rows.join(per, "__name").withColumn("__copies", F.col("__full") + (F.col("__place") <= F.col("__cut")).cast("long"))
    return sources, found.select("row", *_ADDED)


def mixture(docs: DataFrame, target: Target, tokens: Column | str | None = None, budget: int | None = None, seed: int = 5) -> DataFrame:
    """The rows of the mixture, with the columns of docs, whatever their names: each row as often as its copies say. See copies."""
    _, rows = _copied(docs, target, tokens, budget, seed)
    return rows.filter("__copies > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select("row.*")
