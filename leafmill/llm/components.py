"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum((F.xxhash64("a", "b") % 1_000_003).cast("long"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node go to the least of its neighbourhood."""
    near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the least of them. Edges run from the larger node to the smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("low"))
    others = edges.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(least.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame, label: str) -> DataFrame:
    """`a` and `b`, the least node of a's component, for every node but those least ones.

    `edges` has two long columns `a`, `b` without nulls; direction and repeats do not
    matter. The edges of each round are stored, and rounds end when they change nothing:
    about as many as the logarithm of the longest path.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(now, label)
    before, mark = None, _mark(now)
    while mark != before:
        before = mark
        now = stored(_small_star(stored(_large_star(now), label)), label)
        mark = _mark(now)
    return now
