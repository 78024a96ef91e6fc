"""Merging records of one species that arrive one after the other."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basalt.functions.text import DEFAULT_WEIGHT, WEIGHTS, is_primary, weight


def merge_records(df: DataFrame, keys: list[str], pos: str = "pos", status: str = "status") -> DataFrame:
    """One row a key: the status of least weight (the earliest of equals), all else from the last primary row after the first
    row that isn't primary, or else from the first row.

    Two aggregations in place of a fold, so a key with very many records is combined before each shuffle. Null keys are a key of
    their own, a null status weighs as an unknown one, an empty table gives no rows, and all columns are kept; none may begin
    with two underscores."""
    meta = [c for c in df.columns if c not in (*keys, status)]
    primary = is_primary(F.col(status))
    turn = df.groupBy(*keys).agg(F.min(F.when(~primary, F.col(pos))).alias("__turn"))
    # keys may be null: compare them as such
    same = None
    left = df.select("*")
    for k in keys:
        turn = turn.withColumnRenamed(k, f"__{k}")
        cond = F.col(k).eqNullSafe(F.col(f"__{k}"))
        same = cond if same is None else same & cond
    joined = left.join(turn, same).drop(*(f"__{k}" for k in keys))
    late = primary & (F.col(pos) > F.col("__turn"))
    row = F.struct(*meta)
    got = joined.groupBy(*keys).agg(
        F.min_by(status, F.struct(weight(F.col(status)), pos)).alias(status),
        F.coalesce(F.max_by(F.when(late, row), F.when(late, F.col(pos))), F.min_by(row, pos)).alias("__m"),
    )
    return got.select(*keys, status, *(F.col("__m")[c].alias(c) for c in meta)).select(*df.columns)


def merge_fold(df: DataFrame, keys: list[str], group: list[str], pos: str = "pos", status: str = "status") -> DataFrame:
    """The same, literally: records are folded in their order within ``group``, which must not split a key.

    For what needs each arrival's outcome; df gets ``outcome`` (added, upgraded, duplicate), and rows keep their columns. A group is
    held in one task, so it should be a small share of the table. An empty table gives no rows."""
    schema = df.select("*", F.lit("").alias("outcome"), F.lit("").alias("final_status"), F.col(pos).alias("meta_pos")).schema

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(pos, kind="stable")
        held: dict[tuple, list] = {}
        outcomes, finals, metas = [], [], []
        for key, s, p in zip(rows[keys].itertuples(index=False, name=None), rows[status], rows[pos]):
            now = held.get(key)
            if now is None:
                held[key] = [s, p]
                outcomes.append("added")
            else:
                lower = WEIGHTS.get(s, DEFAULT_WEIGHT) < WEIGHTS.get(now[0], DEFAULT_WEIGHT)
                final = s if lower else now[0]
                if s in ("valid", "dubious") and now[0] not in ("valid", "dubious"):
                    outcomes.append("upgraded")
                    now[:] = [final, p]
                elif final != now[0]:
                    outcomes.append("upgraded")
                    now[0] = final
                else:
                    outcomes.append("duplicate")
            finals.append(held[key][0])
            metas.append(held[key][1])
        return rows.assign(outcome=outcomes, final_status=finals, meta_pos=metas)

    return df.groupBy(*group).applyInPandas(fold, schema)


def folded(df: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """The state after the last arrival of each key of a fold: its status and the arrival its metadata come from."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct("final_status", "meta_pos"), pos).alias("__l"))
    return last.select(*keys, F.col("__l.final_status").alias("status"), F.col("__l.meta_pos").alias("pos"))


def page_skips(df: DataFrame) -> DataFrame:
    """Fold of pages' records with the page's own rule: (pos, page, section, genus, species, status) in, outcome out.

    A main record is skipped if its epithet stood on the page before; a synonym too, but it counts as seen only once it was
    added. What a synonym meets depends on records with the same epithet alone, so epithets are folded apart; an epithet is held
    in one task. A null epithet is one of its own, an empty table gives no rows, further columns are kept."""
    out = df.select("*", F.lower("genus").alias("__g"), F.lower("species").alias("__s"), F.lit("").alias("outcome"))

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos", kind="stable")
        held: dict[str, str] = {}
        seen: set = set()
        outcomes = []
        for page, section, genus, status in zip(rows["page"], rows["section"], rows["__g"], rows["status"]):
            if page in seen:
                outcomes.append("skipped")
                continue
            now = held.get(genus)
            if now is None:
                held[genus], outcome = status, "added"
            else:
                final = status if WEIGHTS.get(status, DEFAULT_WEIGHT) < WEIGHTS.get(now, DEFAULT_WEIGHT) else now
                primary = status in ("valid", "dubious") and now not in ("valid", "dubious")
                outcome = "upgraded" if primary or final != now else "duplicate"
                held[genus] = final
            if section == 0 or outcome == "added":
                seen.add(page)
            outcomes.append(outcome)
        return rows.assign(outcome=outcomes)

    return out.groupBy("__s").applyInPandas(fold, out.schema).drop("__g", "__s")


def auto_type(df: DataFrame, page: list[str]) -> DataFrame:
    """is_type becomes true for a page's only record."""
    alone = F.count("*").over(Window.partitionBy(*page)) == 1
    return df.withColumn("is_type", F.coalesce("is_type", F.lit(False)) | alone)


def backfill(df: DataFrame, candidate, pairs: dict[str, str]) -> DataFrame:
    """Where ``candidate`` holds, missing values ('-' or null) come from the named other column."""
    missing = lambda c: F.col(c).isNull() | (F.col(c) == "-")
    return df.withColumns({c: F.when(candidate & missing(c) & ~missing(o), F.col(o)).otherwise(F.col(c)) for c, o in pairs.items()})
