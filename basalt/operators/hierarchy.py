"""Paths of a hierarchy, one row for every node."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixes(lineages: DataFrame, source: str = "source", lineage: str = "lineage", pos: str = "pos") -> DataFrame:
    """(node, source, path): every prefix of every lineage (array, oldest first), the first arrival of a node counting. Null and empty
    lineages have no node, a null inside a lineage is a node of its own, and an empty table gives no rows."""
    e = lineages.select(source, pos, lineage, F.posexplode(lineage).alias("i", "node"))
    e = e.select("node", F.struct(F.col(source).alias("source"), F.slice(lineage, 1, F.col("i") + 1).alias("path")).alias("r"), F.struct(pos, "i").alias("o"))
    return e.groupBy("node").agg(F.min_by("r", "o").alias("r")).select("node", "r.source", "r.path")


def render(path: Column, node: Column) -> Column:
    """'|A|B|node|', without empty, repeated and own names among the ancestors; '||node|' if there are none."""
    above = F.array_distinct(F.filter(path, lambda x: x.isNotNull() & (x != "") & (x != node)))
    return F.concat(F.lit("|"), F.array_join(above, "|"), F.lit("|"), node, F.lit("|"))


def contains(path: Column, node: str) -> Column:
    """Whether a rendered path holds the node: it and all below it."""
    return path.contains(f"|{node}|")
