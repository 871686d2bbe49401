"""Connected components by alternating star contractions, as joins and groupings; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node ties its larger (large) or smaller neighbours to the smallest node it knows. Edges: a > b, distinct."""
    if large:
        seen = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = edges
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        tied = seen.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        tied = seen.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return tied.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes that are a root themselves have no row.

    links: columns a and b of one type, in any order and with repeats. Each round is a written table; the number of
    rounds is about the logarithm of the longest chain.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    before = None
    while True:
        edges = written(_star(_star(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
