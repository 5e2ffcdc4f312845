"""Groups that are kept up to date: new links are contracted on the labels that are stored, not on all old links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamwork.operators.components import connected_components


def add_links(labels: DataFrame, links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) after `links` have been added to the groups that `labels` (node, component) holds.

    A link between two nodes is one between their components; a node that is new is its own. Components
    are found among those that a new link touches only, and the labels that they stand in are renamed in
    one join. A component keeps the smallest node it holds, so that any order of batches gives the same
    labels as all links at once. Null ends and loops add nothing; a loop makes its node known.
    """
    # a component is the smallest node in it, so that what a node is not yet known under is itself
    known = labels.select("node", "component")
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    own = lambda side: known.select(F.col("node").alias(side), F.col("component").alias(f"own_{side}"))
    lifted = ends.join(own("a"), "a", "left").join(own("b"), "b", "left").select("a", "b", F.coalesce("own_a", "a").alias("ca"), F.coalesce("own_b", "b").alias("cb"))
    merged = connected_components(lifted, "ca", "cb").select(F.col("node").alias("component"), F.col("component").alias("into"))
    nodes = ends.select(F.col("a").alias("node")).union(ends.select("b")).distinct().join(known, "node", "left_anti").select("node", F.col("node").alias("component"))
    renamed = known.unionByName(nodes).join(merged, "component", "left")
    return renamed.select("node", F.coalesce("into", "component").alias("component"))


def touched(before: DataFrame, after: DataFrame) -> DataFrame:
    """(node, component) of the nodes that are new or whose component has changed: what a stored table has to take over."""
    return after.exceptAll(before.select(*after.columns))
