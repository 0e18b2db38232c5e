"""Connected components by randomised contraction, in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.store import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for every node of a link, the smallest node reachable from it. Links are integer pairs, in any direction.

    Each round every node joins the neighbour, or itself, that is first in an order, and links between the joined nodes go on. Odd
    rounds order by id, which ends stars around small ids at once; even rounds draw the order anew, so that in expectation a fixed
    share of the nodes disappears whatever the graph's shape, and rounds grow with the logarithm of the nodes, also for long chains. A node with very many links is a group minimum (combined before the
    shuffle) and one row of a join whose other side Spark splits. Links of a node with itself give a component of one; null ends
    are left out.
    """
    ends = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a is not null and b is not null")
    now = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels: DataFrame | None = None
    turn = 0
    while labels is None or now.where("a <> b").limit(1).count():
        turn += 1
        near = now.select(F.col("a").alias("node"), F.col("b").alias("to")).union(now.select("b", "a")).union(now.select("a", "a")).union(now.select("b", "b"))
        order = F.struct((F.xxhash64("to", F.lit(turn)) if turn % 2 == 0 else F.col("to")).alias("h"), F.col("to"))
        joins = stored(near.groupBy("node").agg(F.min(order).alias("m")).select("node", F.col("m.to").alias("into")))
        if labels is None:
            labels = joins.select("node", F.col("into").alias("label"))
        else:
            step = joins.withColumnRenamed("node", "label")
            labels = stored(labels.join(step, "label", "left").select("node", F.coalesce("into", "label").alias("label")))
        moved = now.join(joins.select(F.col("node").alias("a"), F.col("into").alias("x")), "a").join(joins.select(F.col("node").alias("b"), F.col("into").alias("y")), "b")
        now = stored(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    least = labels.groupBy("label").agg(F.min("node").alias("component"))
    return labels.join(least, "label").select("node", "component")
