"""The work catalogue: its schema from a template, synchronisation, filters and transitions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.text import capitalize

# The catalogue's internal fields, stages and statuses.
INTERNAL = {"stage": "skeletal", "is_approved": "False", "s_author": ""}
NEXT_STAGE = {"skeletal": "mesh", "mesh": "texture", "texture": "rig", "rig": "finished"}
STAGES = ("skeletal", "mesh", "texture", "rig", "finished")
STATUSES = ("free", "busy", "review", "finished", "needs_fix")
# End of fixed values.


def parse_template(text: str) -> dict[str, str]:
    """Fields and defaults of '{key|default}' marks, in order; notes aren't a field."""
    found = (m.partition("|") for m in re.findall(r"\{(.*?)\}", text))
    return {k.strip(): d.strip() for k, _, d in found if k.strip() != "notes"}


def fill_defaults(df: DataFrame, template: dict[str, str]) -> DataFrame:
    """Exactly the template's and the internal fields: a template's default stands for an absent, empty or '-' value, an
    internal one for an absent value only."""
    out = []
    for k, d in template.items():
        c = F.col(k).cast("string") if k in df.columns else F.lit(None).cast("string")
        out.append(F.when(c.isNull() | c.isin("None", "", "-"), F.lit(d)).otherwise(c).alias(k))
    for k, d in INTERNAL.items():
        if k not in template:
            out.append((F.coalesce(F.col(k).cast("string"), F.lit(d)) if k in df.columns else F.lit(d)).alias(k))
    return df.select(*out)


def find_entries(wanted: DataFrame, entries: DataFrame, migrations: DataFrame) -> DataFrame:
    """wanted (genus, species, ...) with ``entry``, the matching entry's full name: by its own name, ignoring case, else by
    the first migration to its genus whose old name has an entry. Any input may be empty; null names match nothing but their own
    empty spelling; further columns of wanted are kept."""
    names = entries.select(F.lower(F.concat_ws(" ", "genus", "species")).alias("__e")).distinct()
    moved = migrations.select(F.lower("new_genus").alias("__to"), F.lower("old_name").alias("__old"), "pos")
    moved = moved.join(names, F.col("__old") == F.col("__e"), "left_semi").groupBy("__to").agg(F.min_by("__old", "pos").alias("__old"))
    out = wanted.withColumn("__n", F.lower(F.concat_ws(" ", "genus", "species")))
    out = out.join(names, F.col("__n") == F.col("__e"), "left").join(moved, F.lower("genus") == F.col("__to"), "left")
    return out.withColumn("entry", F.coalesce("__e", "__old")).drop("__n", "__e", "__to", "__old")


def sync(listed: DataFrame, entries: DataFrame, migrations: DataFrame, template: dict[str, str]) -> DataFrame:
    """The new catalogue: listed (genus, species, status) with the fields of the entry found, defaults for the rest; entries
    no longer listed disappear. Of entries with one name any is taken; an empty list gives an empty catalogue, and no entries
    give defaults throughout."""
    fields = [c for c in entries.columns if c not in ("genus", "species", "status") and (c in template or c in INTERNAL)]
    held = entries.select(F.lower(F.concat_ws(" ", "genus", "species")).alias("entry"), *fields).dropDuplicates(["entry"])
    found = find_entries(listed.select("genus", "species", "status"), entries, migrations)
    return fill_defaults(found.join(held, "entry", "left"), template)


def query(df: DataFrame, command: str) -> DataFrame:
    """The command language: 'all [status] [stage]', a genus, or a genus and a species. All words of 'all' must hold."""
    words = command.split()
    if words[:1] == ["all"]:
        for w in words[1:]:
            if w not in STATUSES and w not in STAGES:
                raise ValueError(f"no such status or stage: {w}")
            df = df.where(F.col("m_status" if w in STATUSES else "stage") == w)
        return df
    if len(words) == 1:
        return df.where(F.lower("genus") == words[0].lower())
    return df.where(F.lower(F.concat_ws(" ", "genus", "species")) == command.lower())


def transition(action: Column, user: Column, curator: Column) -> dict[str, Column]:
    """New m_status, user, s_author and stage of an entry for an action; unchanged when its guard fails.

    claim, submit, release are the user's; approve and reject the curator's."""
    at, own = F.col("m_status"), F.col("user") == user
    held = F.coalesce(F.col("s_author"), F.lit(""))
    claim = (action == "claim") & at.isin("free", "needs_fix")
    submit = (action == "submit") & (at == "busy") & own
    approve = (action == "approve") & (at == "review") & curator
    reject = (action == "reject") & (at == "review") & curator
    release = (action == "release") & (at == "busy") & own
    rig = F.col("stage") == "rig"
    following = F.col("stage")
    for a, b in NEXT_STAGE.items():
        following = F.when(F.col("stage") == a, F.lit(b)).otherwise(following)
    return {
        "m_status": F.when(claim, "busy").when(submit, "review").when(approve & rig, "finished").when(approve, "free").when(reject, "needs_fix")
        .when(release & (held != ""), "needs_fix").when(release, "free").otherwise(at),
        "user": F.when(claim, user).when(approve, "").when(release, held).otherwise(F.col("user")),
        "s_author": F.when(submit, user).when(approve, "").otherwise(F.col("s_author")),
        "stage": F.when(approve, following).otherwise(F.col("stage")),
    }


def card(item_user: str = "user") -> Column:
    """An entry as text: name and status, work status, stage unless finished, and whose it is."""
    state, user = F.lower("m_status"), F.col(item_user)
    name = F.concat_ws(" ", capitalize(F.col("genus")), "species")
    label = F.when(state.isin("review", "needs_fix"), "author").otherwise("claimed_by")
    owner = F.when(F.coalesce(user, F.lit("")) != "", F.concat(label, F.lit(": @"), user))
    stage = F.when(state != "finished", F.concat(F.lit("stage: "), F.lower("stage")))
    return F.concat_ws("\n", F.concat(name, F.lit(" ("), F.col("status"), F.lit(")")), F.concat(F.lit("status: "), state), stage, owner)


def rewrite(pairs: DataFrame, changes: dict[str, str]) -> DataFrame:
    """(key, value) lines with new values for some keys; all others stay."""
    value = F.col("value")
    for k, v in changes.items():
        value = F.when(F.col("key") == k, F.lit(v)).otherwise(value)
    return pairs.withColumn("value", value)


def specimens(action: Column, user: Column, given: Column) -> dict[str, Column]:
    """New base_specimen and scale_specimen: a user who submits own work of the first stage may name them (given, a struct with
    these two fields); empty or null names change nothing. To be taken before ``transition``."""
    told = (action == "submit") & (F.col("m_status") == "busy") & (F.col("user") == user) & (F.col("stage") == STAGES[0])
    named = lambda c: told & (F.coalesce(given[c], F.lit("")) != "")
    return {c: F.when(named(c), given[c]).otherwise(F.col(c)) for c in ("base_specimen", "scale_specimen")}


def mine(df: DataFrame, user: Column) -> DataFrame:
    """What a user is working on."""
    return df.where((F.col("m_status") == "busy") & (F.col("user") == user))
