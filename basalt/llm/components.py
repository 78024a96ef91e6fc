"""Connected components by alternating large and small stars, all on the cluster.

Each round hangs a node's larger neighbours, then its smaller ones, on the smallest node in sight; rounds grow with the
logarithm of the longest path, and a hub's edges are combined before any shuffle. Every round is written to the
shared folder, so no lineage builds up and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import discard, join_split, materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges (a, b) but the labels themselves: the smallest node it is connected to.

    Null ends, loops and repeated edges are ignored; no edges give no rows."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(now, "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = mark
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        # a label may be that of a third of all nodes
        hubs = materialize(least.join(now.groupBy(F.col("v").alias("u")).agg(F.count("*").alias("n")), "u"), "hubs")
        large = join_split(now.select(F.col("v").alias("u"), F.col("u").alias("w")), hubs, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        # a node that is larger than all its neighbours keeps its smallest one
        large = large.union(now.join(least, "u").select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        old, now = now, materialize(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct(), "edges")
        discard(old, hubs)


def forest_labels(parents: DataFrame) -> DataFrame:
    """(node, label) of edges (a, b) that give each a one smaller b: the tree's root, by doubling the way up each round."""
    now = materialize(parents.select(F.col("a").alias("node"), F.col("b").alias("label")), "forest")
    while True:
        up = now.select(F.col("node").alias("label"), F.col("label").alias("to"))
        step = materialize(now.join(up, "label", "left").select("node", F.coalesce("to", "label").alias("label"), F.col("to").isNotNull().alias("moved")), "forest")
        discard(now)
        now = step.select("node", "label")
        now._written_to = step._written_to
        if step.where("moved").isEmpty():
            return now
