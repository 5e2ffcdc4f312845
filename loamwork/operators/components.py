"""Connected components of an undirected graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.runtime import cut


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Return (node, component): each node that has an edge, with the smallest node it can reach.

    Every round links each node's larger neighbours, then its smaller ones, to the least node
    near it; the number of rounds grows with the logarithm of a component's diameter. A round is
    two group-wise minima (combined before the shuffle, so that a hub sends one row per task) and
    two equi-joins, which adaptive execution may split at a hub. Each round's edges are written to
    the checkpoint folder. Null ends and loops are ignored.
    """
    a, b = F.col(left), F.col(right)
    links = cut(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    state = _state(links)
    while state[0]:
        links = cut(_small_star(_large_star(links)))
        last, state = state, _state(links)
        if state == last:
            break
    own = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return own.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v"))).first())
