"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnatlas.llm.text import remove_stored, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    around = _both(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return around.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").filter("b <> m").select(F.col("m").alias("a"), "b")
    return linked.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b); the component is its smallest node.

    The links stay in Spark. Each round is written to the shared folder, so no lineage grows, and
    ends as the links no longer change: then every node is linked to its smallest one alone. Rounds
    grow with the logarithm of the longest path. A node with very many links is summed on the map
    side first, and its join is one that adaptive execution splits. Links of a node with itself and
    repeated links change nothing; an empty table gives an empty one.
    """
    now = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    mark = _mark(now)
    while mark[0]:
        after = stored(_small_star(_large_star(now)), "links")
        remove_stored(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
