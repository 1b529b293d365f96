"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _least(pairs: DataFrame) -> DataFrame:
    """Stored, so that the join with it shuffles both sides and adaptive execution can split a hub."""
    return written(pairs.groupBy("a").agg(F.min("b").alias("least")), "least")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node but the roots.

    ``edges`` has columns ``a`` and ``b`` of one orderable type, in any order, repeats and
    loops allowed. Each round links every node's larger neighbours to its least one (large
    star), then its smaller ones (small star); paths halve, so rounds grow with the logarithm
    of the longest. Nothing is gathered per node: minima are aggregated before they are
    shuffled. An empty table gives no rows.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = written(pairs.filter("a != b").distinct(), "edges")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a"))
        large = written(large.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "large")
        least = _least(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.filter("a != b").unionByName(least.select("a", F.col("least").alias("b"))).distinct()
        pairs = written(small, "small")
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
