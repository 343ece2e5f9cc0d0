"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import removed, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b long): label is the smallest node reachable.

    Each round points every node's larger neighbours at the smallest one and then every node at the smallest neighbour
    that is left, which turns each component into a star in about log(nodes) rounds; they end when a round changes
    nothing. Self-links name isolated nodes. Nulls and repeated links have no effect.
    """
    edges = written(links.select("a", "b").where("a is not null and b is not null").distinct(), "links")
    mark, seen = _mark(edges), None
    while mark != seen and mark[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        # Larger neighbours get the smallest neighbour (or the node itself) as their own.
        large = both.join(low, "a").where("b >= a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*").distinct()
        before, edges = edges, written(small, "links")
        removed(before)
        seen, mark = mark, _mark(edges)
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))


def _mark(edges: DataFrame) -> tuple:
    """Tells sets of links apart: their number and two xors of hashes."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(7)))).first())
