"""Connected components of links that may be too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.columns import stored, tasks_for


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _towards_least(edges: DataFrame, tasks: int) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.coalesce(tasks).distinct().coalesce(tasks)


def _smaller_to_least(edges: DataFrame, tasks: int) -> DataFrame:
    """``a > b`` in every link: link a node and its smaller neighbours to the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionAll(least.select("a", F.col("least").alias("b"))).coalesce(tasks).distinct()


def _are_stars(edges: DataFrame, tasks: int) -> bool:
    """``a > b`` in every link: whether each node has one smaller neighbour or none, which itself has none."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR (up = 1 AND down = 1)").coalesce(tasks).isEmpty()


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node that is not itself the least.

    ``edges`` needs no order and may repeat; they are counted, so they should be stored. Links are turned towards least
    nodes by turns until they are stars around these, which takes about the logarithm of the number of nodes in rounds;
    each round is written out. A node with very many links is spread by the partial minimum and by the split of skewed
    joins. Steps on few links run in few tasks.
    """
    a, b = F.col(first), F.col(second)
    tasks = tasks_for(edges)
    current = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    current = stored(current, "links", tasks=tasks)
    while not _are_stars(current, tasks):
        current = stored(_smaller_to_least(_towards_least(current, tasks), tasks), "links", tasks=tasks)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def joined_further(joined: DataFrame, edges: DataFrame) -> DataFrame:
    """The :func:`components` there are once ``edges``, ``a`` and ``b``, come to the links that made ``joined``.

    Only the components that the new edges touch are worked on, each as one node. Both should be stored.
    """
    tasks = max(tasks_for(joined), tasks_for(edges))
    for end in ("a", "b"):
        roots = joined.select(F.col("node").alias(end), "component")
        edges = edges.join(roots, end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    found = stored(edges.where("a <> b"), "new-links", tasks=tasks)
    if found.isEmpty():
        return joined
    moved = components(found, "a", "b")
    roots = moved.select(F.col("node").alias("component"), F.col("component").alias("least"))
    rest = joined.join(roots, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
    return stored(rest.unionByName(moved), "components", tasks=tasks)
