"""Filter interaction audit: what each quality filter removes, in every order of the filters, from counts of bit combinations."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import small, written

#: The filters by letter; a document fails a filter where its condition is true. E is not a condition of one text, see copies.
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
_CLASSES = 1 << len(FILTERS)
_BIT = {letter: 1 << i for i, letter in enumerate(FILTERS)}


def conditions(text: Column) -> dict[str, Column]:
    """A: under 200 words; B: fewer than half of the words differ; C: more than 3 % of the code points are A-Z; D: holds a code sign."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": F.size(words) < 200, "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals > 3 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def copies(texts: DataFrame) -> DataFrame:
    """(doc_id, hash): the rows whose text a smaller doc_id has too. texts: doc_id, hash, text.

    A left-semi join on hash, exact text and a smaller doc_id. Only texts whose hash occurs twice are moved; against
    them stand the texts once each, with the smallest doc_id, summed up before the shuffle, so that the rows of a
    hot text have one partner, and their side of the join is one that Spark can split.
    """
    shared = written(texts.groupBy("hash").count().filter("count > 1").select("hash"), "shared")
    again = texts.join(small(shared), "hash", "left_semi")
    first = written(again.groupBy("hash", "text").agg(F.min("doc_id").alias("first_id")), "first")
    a, b = again.alias("a"), first.alias("b")
    smaller = F.expr("a.hash = b.hash AND a.text = b.text AND b.first_id < a.doc_id")
    return a.join(b, smaller, "left_semi").select("doc_id", "hash")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by language, failed filters as bits, and labels.

    The ids that fail by a copy are united with the ids and bits of the other filters and summed by id: a row is known by its
    doc_id and the hash of its text, so rows that repeat an id with other texts are told apart.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    failed = sum([F.when(c, _BIT[x]).otherwise(0) for x, c in conditions(F.col("text")).items()], F.lit(0))
    own = texts.select("doc_id", "hash", "part", failed.alias("mask"), F.lit(1).cast("long").alias("n"))
    # Repeated rows of a copy carry the bit each; it counts once by bit_or.
    by_copy = copies(texts.select("doc_id", "hash", "text")).select(
        "doc_id", "hash", F.lit(None).cast("string").alias("part"), F.lit(_BIT["E"]).alias("mask"), F.lit(0).cast("long").alias("n"))
    bits = own.groupBy("doc_id", "hash", "part").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n")).unionByName(by_copy)
    each = bits.groupBy("doc_id", "hash").agg(F.bit_or("mask").alias("mask"), F.collect_list(F.when(F.col("n") > 0, F.struct("part", "n"))).alias("parts"))
    each = each.select("doc_id", "mask", F.inline("parts"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce("good", F.lit(False))).alias("good"), F.max(F.coalesce("toxic", F.lit(False))).alias("toxic"))
    no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return each.join(marks, "doc_id", "left").groupBy("part", "mask", no("good"), no("toxic")).agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (language; null: empty), order of the filters and step: part, filter_order, step, filter, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    All 120 orders follow from the counts of 32 combinations of failed filters: a step removes the combinations that
    hold its filter and none before it. Counts of documents within the part: kept after the step; removed by it;
    redundant, failing its filter but removed before; unique_fails, failing its filter alone; good_lost and toxic_lost,
    removed with quality or toxic label 1; shapley, removed by the filter over all orders.

    Null texts are empty (they fail A alone, and E, if a smaller doc_id has an empty text too). Rows count as often as they
    repeat; a null doc_id is neither smaller nor larger than another, so such rows never fail E. Labels that repeat a
    document count as 1 if any does; labels of unknown documents or without doc_id are left out. An empty table gives no
    rows; other columns are ignored.
    """
    found = combinations(docs, labels)
    lists = {"all": F.lit(True), "good": F.col("good"), "toxic": F.col("toxic")}
    sums = [F.array(*[F.sum(F.when(which & (F.col("mask") == m), F.col("n")).otherwise(0)) for m in range(_CLASSES)]).alias(f"n_{name}")
            for name, which in lists.items()]
    parts = found.groupBy("part").agg(*sums)
    orders = F.explode(F.array(*[F.lit(o) for o in ORDERS]))
    steps = parts.select("*", orders.alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))

    def bits(letters: Column) -> Column:
        return sum([F.when(letters.contains(x), b).otherwise(0) for x, b in _BIT.items()], F.lit(0))

    steps = steps.withColumns({"filter": F.substring("filter_order", F.col("step"), F.lit(1)), "earlier": F.substring("filter_order", F.lit(1), F.col("step") - 1)})
    steps = steps.withColumns({"own": bits(F.col("filter")), "before": bits(F.col("earlier"))})
    own, before = F.col("own"), F.col("before")

    def total(name: str, holds) -> Column:
        """The documents of the combinations m for which holds(m)."""
        counts = F.filter(F.transform(f"n_{name}", lambda n, m: F.struct(m.alias("m"), n.alias("n"))), lambda x: holds(x["m"]))
        return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x["n"])

    has = lambda m: m.bitwiseAND(own) != 0
    free = lambda m: m.bitwiseAND(before) == 0
    taken = lambda m: has(m) & free(m)
    weighted = F.transform("n_all", lambda n, m: F.when(has(m), n * (F.lit(factorial(len(FILTERS))) / F.greatest(F.bit_count(m), F.lit(1))).cast("long")).otherwise(0))
    return steps.select(
        "part", "filter_order", "step", "filter",
        total("all", lambda m: free(m) & ~has(m)).alias("kept"), total("all", taken).alias("removed"),
        total("all", lambda m: has(m) & ~free(m)).alias("redundant"), total("all", lambda m: m == own).alias("unique_fails"),
        total("good", taken).alias("good_lost"), total("toxic", taken).alias("toxic_lost"),
        F.aggregate(weighted, F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"))
