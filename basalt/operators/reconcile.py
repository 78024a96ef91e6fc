"""Plans that bring folders in line with the catalogue; nothing is moved here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_plan(wanted: DataFrame, root: DataFrame, archive: DataFrame, migrations: DataFrame) -> DataFrame:
    """(genus, species, action, source) for each wanted name: OK in the root, RESURRECT from the archive, MIGRATE from the
    first old name with the same species in the root, else in the archive, or CREATE.

    Names match ignoring case. Any input may be empty; a null genus or species counts as an empty part of its name, and a null old
    name is nowhere; of repeated wanted names each has a row; further columns are ignored."""
    name = F.concat_ws(" ", "genus", "species")
    dirs = lambda d, flag: d.select(F.lower(name).alias(f"__{flag}")).distinct()
    old = migrations.select("pos", F.lower("new_genus").alias("__to"), F.lower("old_name").alias("__old"), F.lower(F.element_at(F.split("old_name", " "), -1)).alias("__sp"))
    placed = old.join(dirs(root, "r"), F.col("__old") == F.col("__r"), "left").join(dirs(archive, "a"), F.col("__old") == F.col("__a"), "left")
    placed = placed.withColumn("__where", F.when(F.col("__r").isNotNull(), 0).when(F.col("__a").isNotNull(), 1)).where("__where is not null")
    placed = placed.groupBy("__to", "__sp").agg(F.min_by("__old", F.struct("__where", "pos")).alias("__old"))
    w = wanted.withColumn("__n", F.lower(name))
    w = w.join(dirs(root, "r"), F.col("__n") == F.col("__r"), "left").join(dirs(archive, "a"), F.col("__n") == F.col("__a"), "left")
    w = w.join(placed, (F.lower("genus") == F.col("__to")) & (F.lower("species") == F.col("__sp")), "left")
    action = F.when(F.col("__r").isNotNull(), "OK").when(F.col("__a").isNotNull(), "RESURRECT").when(F.col("__old").isNotNull(), "MIGRATE").otherwise("CREATE")
    return w.select("genus", "species", action.alias("action"), F.when(action == "MIGRATE", F.col("__old")).alias("source"))


def archive_plan(wanted: DataFrame, root: DataFrame, plan: DataFrame) -> DataFrame:
    """(genus, species) of folders to archive: not wanted, not migrated away, not hidden. Any input may be empty; a folder without a
    genus or species name is none; further columns are ignored."""
    name = F.lower(F.concat_ws(" ", "genus", "species"))
    shown = root.where(~F.col("genus").startswith(".") & ~F.col("genus").startswith("_deleted_") & ~F.col("species").startswith(".")).withColumn("__n", name)
    active = wanted.select(name.alias("__n")).union(plan.where("source is not null").select(F.col("source").alias("__n")))
    return shown.join(active, "__n", "left_anti").select("genus", "species")
