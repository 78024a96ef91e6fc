"""Differences between two snapshots, and the registry of what was lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, tombstones: DataFrame, first_run: bool) -> DataFrame:
    """(page, species, change) over facts (page, species, value): OK, UPDATED, RESURRECTED, INIT, NEW or LOST.

    species is null for a page's own fact. A species comes back when its full name is buried, on a first run too; a page when
    a buried name begins with it, ignoring case. Old facts without a new one are lost."""
    n = new.select("page", "species", F.struct("value").alias("now"))
    o = old.select(F.col("page").alias("op"), F.col("species").alias("os"), F.struct("value").alias("was"))
    facts = n.join(o, F.col("page").eqNullSafe(F.col("op")) & F.col("species").eqNullSafe(F.col("os")), "full_outer")
    facts = facts.withColumns({"page": F.coalesce("page", "op"), "species": F.when(F.col("now").isNotNull(), F.col("species")).otherwise(F.col("os"))}).drop("op", "os")
    buried = tombstones.select("name").distinct()
    exact = buried.select(F.col("name").alias("__full"), F.lit(True).alias("__back"))
    facts = facts.join(exact, F.concat_ws(" ", "page", "species") == F.col("__full"), "left").drop("__full")
    # a page is the part of a buried name before any of its blanks
    low = F.split(F.lower("name"), " ")
    prefix = F.explode(F.transform(F.sequence(F.lit(1), F.size(low) - 1), lambda i: F.array_join(F.slice(low, 1, i), " ")))
    pages = buried.where(F.col("name").contains(" ")).select(prefix.alias("__p")).distinct().withColumn("__returns", F.lit(True))
    facts = facts.join(pages, F.lower("page") == F.col("__p"), "left").drop("__p")
    is_page = F.col("species").isNull()
    change = (
        F.when(F.col("now").isNull(), "LOST")
        .when(F.col("was").isNotNull(), F.when(F.col("was").eqNullSafe(F.col("now")), "OK").otherwise("UPDATED"))
        .when(~is_page & F.col("__back"), "RESURRECTED")
        .when(F.lit(first_run), "INIT")
        .when(is_page & F.col("__returns"), "RESURRECTED")
        .otherwise("NEW")
    )
    return facts.select("page", "species", change.alias("change"))


def next_tombstones(diff: DataFrame, tombstones: DataFrame) -> DataFrame:
    """(name): buried names but the resurrected ones, and the species lost this time."""
    name = F.concat_ws(" ", "page", "species").alias("name")
    back = diff.where((F.col("change") == "RESURRECTED") & F.col("species").isNotNull()).select(name)
    lost = diff.where((F.col("change") == "LOST") & F.col("species").isNotNull()).select(name)
    return tombstones.select("name").join(back, "name", "left_anti").union(lost).distinct()


def history(diff: DataFrame) -> DataFrame:
    """(change, n): how many facts changed each way; what is new at the start or unchanged isn't history."""
    return diff.where(~F.col("change").isin("OK", "INIT")).groupBy("change").agg(F.count("*").alias("n"))


def history_entries(diff: DataFrame, first_run: bool) -> DataFrame:
    """(tag, n): a first run's one baseline line with the number of its facts; later a line for each kind of change, and none
    where nothing changed. An empty first run has a baseline of 0."""
    if first_run:
        return diff.agg(F.lit("BASELINE").alias("tag"), F.count("*").alias("n"))
    return history(diff).withColumnRenamed("change", "tag")
