"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_MADE: dict[str, set[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a temporary folder if everything runs on this machine, else an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        path = _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="basalt-"))
    return path.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/basalt/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_dir(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def made(spark: SparkSession) -> set[str]:
    """Folders made in this application that weren't deleted."""
    return set(_MADE.get(spark.sparkContext.applicationId, ()))


def delete(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        _MADE.get(spark.sparkContext.applicationId, set()).discard(path)


def discard(*tables: DataFrame | None) -> None:
    """Delete what materialize wrote for these; nothing may read them any more."""
    for t in tables:
        path = getattr(t, "_written_to", None)
        if path:
            delete(t.sparkSession, path)


def discard_others(spark: SparkSession, before: set[str], *keep: DataFrame) -> None:
    """Delete what was made since ``before``, but for these tables."""
    delete(spark, *(made(spark) - before - {getattr(t, "_written_to", None) for t in keep}))
