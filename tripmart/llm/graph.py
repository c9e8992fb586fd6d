"""Connected components by large-star and small-star steps on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Joins each node's neighbours to the smallest of them (and of the node itself). ``small``
    looks at smaller neighbours only and joins the node itself too; otherwise only larger ones move."""
    both = edges.select("a", "b") if small else edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:  # a is the larger end
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")).select(F.col("a").alias("n"), "m")
    moved = both.join(least, F.col("a") == F.col("n"))
    if small:
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    else:
        out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, component`` (its smallest node) for all nodes of the edges ``a, b``.

    Each round is a large-star and a small-star step; the edges become stars around the components'
    smallest nodes in a number of rounds that grows with the logarithm of the longest chain. Minima are
    aggregated before they are shuffled; a node with very many neighbours is a skewed join key, which
    adaptive execution splits. Rounds end when the edge set stays the same. Null ends are ignored.
    """
    now = stored(edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = tuple(seen)
        now = stored(_star(_star(now, False), True), "edges")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
