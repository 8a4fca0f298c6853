"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.store import stored


def _with_least(edges: DataFrame, least) -> DataFrame:
    """``edges`` with ``m``, the smallest of ``u``'s neighbours by the rule ``least``.

    The join is on a key that the aggregate is not dealt by, so that both inputs are plain shuffles: adaptive execution
    can then split a node with very many neighbours.
    """
    key = F.col("u").bitwiseXOR(F.lit(1))
    found = edges.groupBy("u").agg(F.min("v").alias("m")).select(key.alias("k"), least.alias("m"))
    return edges.withColumn("k", key).join(found, "k").select("u", "v", "m")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    ties = _with_least(both, F.least("u", "m")).where("v > u")
    return ties.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's smaller neighbours, and itself, are tied to the smallest of them."""
    ties = _with_least(edges, F.col("m")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = edges.groupBy("u").agg(F.min("v").alias("v"))
    return ties.unionByName(own).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, the smallest node that it is connected to, of every node with an edge to another.

    Stars are made in turn around the smallest neighbours until each component is one star (about the logarithm of the
    longest path in rounds). Minima are combined before each shuffle; a round is stored, so a lost executor repeats part
    of one round; only two sums a round come to the driver. NULLs and loops are no edges.
    """
    pairs = edges.where(F.col(a) != F.col(b))
    state = stored(
        pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    sign = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))]
    before, after = None, tuple(state.agg(*sign).first())
    while before != after:
        state = stored(_small_star(_large_star(state)), "stars")
        before, after = after, tuple(state.agg(*sign).first())
    smallest = state.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(smallest)
