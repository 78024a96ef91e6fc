"""Status validation against a list of genera."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basalt.functions.text import weight

TRUTH = ("genus", "status")


def resolve_status(species: DataFrame, truth: DataFrame, pos: str = "pos") -> DataFrame:
    """species with ``status`` settled and ``outcome`` OK or FIX: of its own status and its genus's (valid where the list has
    none, the last of repeated ones) the one with less weight; ties keep its own.

    The join is plain: the optimizer broadcasts the list when it is small enough, and shuffles it otherwise."""
    known = truth.where(F.col("genus").isNotNull() & F.col("status").isNotNull())
    known = known.groupBy(F.lower("genus").alias("__g")).agg(F.max_by(F.lower("status"), pos).alias("__s"))
    joined = species.join(known, F.lower(species["genus"]) == F.col("__g"), "left")
    theirs = F.coalesce("__s", F.lit("valid"))
    own = F.lower(F.col("status"))
    joined = joined.withColumn("__t", F.when(weight(theirs) < weight(own), theirs).otherwise(own))
    out = joined.withColumn("outcome", F.when(F.col("__t") == own, "OK").otherwise("FIX")).withColumn("status", F.col("__t"))
    return out.drop("__g", "__s", "__t")
