"""Operators that depend on arrival: every one takes an explicit, unique order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.functions.text import parse_year
from basalt.storage import materialize


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each key's first row; an aggregation, so copies are combined before the shuffle."""
    return _keep(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Each key's last row: a map whose later entries overwrite earlier ones."""
    return _keep(df, keys, order, F.max_by)


def _keep(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    got = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__r"))
    return got.select(*keys, *(F.col("__r")[c].alias(c) for c in rest)).select(*df.columns)


def run_dedup(df: DataFrame, by: list[str], order: list[str], keys: list[str]) -> DataFrame:
    """Drop rows whose keys equal the row before them; nulls equal nulls."""
    w = Window.partitionBy(*by).orderBy(*order)
    key = F.struct(*keys)
    before = F.lag(key).over(w)
    return df.withColumn("__b", before).where(F.col("__b").isNull() | ~F.col("__b").eqNullSafe(key)).drop("__b")


def scientific_order() -> list[Column]:
    """Genus, types first, year (others last), species."""
    year = F.when(F.col("year").rlike(r"^\d+$"), F.col("year").try_cast("int"))
    return [F.lower("genus"), F.when(F.col("is_type"), 0).otherwise(1), F.coalesce(year, F.lit(9999)), F.lower("species")]


def numbered(df: DataFrame, order: list, name: str = "id") -> DataFrame:
    """df with numbers from 1 in a total order, without gathering it in one task: rows are range-sorted and written once; a row's
    number is its place in its range and the sizes of the ranges before (a row each, broadcast)."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(width, *order).sortWithinPartitions(*order)
    held = materialize(ranged.withColumn("__m", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__m", 33)
    sizes = held.groupBy(part.alias("__p")).agg(F.count("*").alias("__n"))
    before = sizes.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__b"))
    place = F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__b") + 1
    return held.join(F.broadcast(before), part == F.col("__p")).withColumn(name, place.cast("long")).drop("__m", "__p", "__b")


def species_table(fauna: DataFrame) -> DataFrame:
    """Rows in scientific order with ids from 1; the age is renamed, the source dropped, the year a number."""
    age = F.col("age").alias("age_ma")
    return numbered(fauna, [*scientific_order(), "pos"]).select(
        "id", "genus", "species", F.coalesce("is_type", F.lit(False)).alias("is_type"), "status", "clade", "stage", age, "author", parse_year(F.col("year")).alias("year")
    )


def type_last_order() -> list[Column]:
    """Genus, types last, year (unknown first): the order that the published list asks for, unlike scientific_order."""
    return [F.col("genus").asc_nulls_first(), F.col("is_type").asc_nulls_first(), F.col("year").asc_nulls_first()]
