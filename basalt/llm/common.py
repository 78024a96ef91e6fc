"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.storage import discard, discard_others, made, materialize, new_dir, shared_dir

__all__ = ["SPACE", "WORD", "discard", "discard_others", "join_split", "made", "materialize", "new_dir", "read_table", "shared_dir", "shield"]

#: Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A key of up to so many rows is no hot one; and no more keys than this are ever broadcast as hot ones.
HOT_ROWS = 1_000
HOT_KEYS = 100_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; only Spark's readers touch the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shield(df: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with its columns that begin as this subpackage's own ones do (``__``) under other names, and what names them back."""
    taken, new = {c.lower() for c in df.columns}, {}
    for c in df.columns:
        if c.startswith("__"):
            n = len(new)
            while f"__user_{n}" in taken:
                n += 1
            taken.add(f"__user_{n}")
            new[c] = f"__user_{n}"
    return df.withColumnsRenamed(new), lambda out: out.withColumnsRenamed({v: k for k, v in new.items()})


def join_split(rows: DataFrame, keyed: DataFrame, key: str | list[str], total: int | None = None) -> DataFrame:
    """rows joined with keyed, which has each key once with ``n``, the number of its rows; both should be written tables.

    Keys of more than HOT_ROWS rows, and of more than their total over HOT_KEYS, are joined where their rows lie, by a broadcast
    of at most HOT_KEYS rows of keyed; all others are shuffled, so no task gets more than that of one key."""
    total = (keyed.agg(F.sum("n")).first()[0] or 0) if total is None else total
    hot = keyed.where(F.col("n") > max(HOT_ROWS, total // HOT_KEYS))
    # rows of hot keys leave before the shuffle
    cold = rows.join(F.broadcast(hot.select(*([key] if isinstance(key, str) else key))), key, "left_anti")
    cold = cold.join(keyed.where(F.col("n") <= max(HOT_ROWS, total // HOT_KEYS)).hint("merge"), key)
    return rows.join(F.broadcast(hot), key).unionByName(cold).drop("n")
