"""Ages on a time scale: overlap join with measurement error, and a fallback to marginal matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from basalt.functions.text import parse_double, read_age


#: Rows of a scale up to which it is broadcast to the items, and up to which it is part of the expression itself.
SCALE_ROWS = 10_000
LITERAL_ROWS = 500


def scale_bounds(scale: DataFrame) -> DataFrame:
    """(at, name, older, younger, error), at being the scale's pos: the younger bound is the start of the row before, whatever that row is; rows
    without bounds are dropped after that. The scale is one short ordered list."""
    w = Window.orderBy("pos")
    start = parse_double(F.col("start_ma").cast("string"))
    younger = F.when(F.row_number().over(w) == 1, F.lit(0.0)).otherwise(F.lag(start).over(w))
    raw = F.upper(F.col("uncertainty").cast("string"))
    error = F.when(raw.isNull() | raw.isin("-", "", "NONE"), 0.0).otherwise(raw.try_cast("double"))
    name = F.when(F.col("stage").isNull() | (F.col("stage") == "-"), F.col("period")).otherwise(F.col("stage"))
    out = scale.select(F.col("pos").alias("at"), name.alias("name"), F.round(start, 4).alias("older"), F.round(younger, 4).alias("younger"), F.round(error, 4).alias("error"))
    return out.where(F.col("older").isNotNull() & F.col("younger").isNotNull() & F.col("error").isNotNull())


def interval_matches(items: DataFrame, bounds: DataFrame, key: str = "id") -> DataFrame:
    """(key, d_max, d_min, at, name, marginal) for every stage that an item's age (d_max, d_min) meets.

    A point lies in [younger - error, older + error); an interval must overlap, marginally if by less than the error. A scale of up
    to SCALE_ROWS rows is broadcast; items meet a larger one by bins as wide as its longest stage."""
    point = F.col("d_max") == F.col("d_min")
    inside = point & (F.col("d_max") >= F.col("younger") - F.col("error")) & (F.col("d_max") < F.col("older") + F.col("error"))
    over = F.round(F.least("d_max", "older") - F.greatest("d_min", "younger"), 4)
    meets = inside | (~point & (over > 0))
    got = [key, "d_max", "d_min", "at", "name", (~point & (over < F.col("error"))).alias("marginal")]
    size, width = bounds.agg(F.count("*"), F.max(F.col("older") - F.col("younger") + 2 * F.col("error"))).first()
    if size <= SCALE_ROWS:
        return items.join(F.broadcast(bounds), meets).select(*got)
    width = max(width, 1e-9)
    bins = lambda a, b: F.explode(F.sequence(F.floor(a / width).cast("long"), F.floor(b / width).cast("long")))
    first, last = F.col("younger") - F.col("error"), F.col("older") + F.col("error")
    bounds = bounds.select("*", bins(first, last).alias("__b"), F.floor(first / width).cast("long").alias("__first"))
    items = items.select(key, "d_max", "d_min", bins(F.col("d_min"), F.col("d_max")).alias("__b"))
    # a pair meets in several bins; the first that both have counts
    own = F.col("__b") == F.greatest("__first", F.floor(F.col("d_min") / width).cast("long"))
    return items.join(bounds, "__b").where(meets & own).select(*got)


def assign_stages(items: DataFrame, scale: DataFrame, key: str = "id", age: str = "age", stage: str = "stage") -> DataFrame:
    """items with their label from the scale, oldest first: ``label``, older and younger bound of its stages, and ``outcome``
    (OK, FIX, SKIP without an age, OUT_OF_BOUNDS). A label that only differs in case or dashes keeps its old spelling. The key must
    be unique; an empty scale puts every age out of bounds, and further columns are kept."""
    aged = items.withColumn("__a", read_age(F.col(age)))
    aged = aged.withColumns({"d_max": F.round(F.col("__a.d_max"), 4), "d_min": F.round(F.col("__a.d_min"), 4)}).drop("__a")
    bounds = scale_bounds(scale)
    short = bounds.limit(LITERAL_ROWS + 1).collect()
    if len(short) <= LITERAL_ROWS:
        return _outcomes(_labelled(aged, short), stage)
    met = interval_matches(aged.where("d_max is not null").select(key, "d_max", "d_min"), bounds, key)
    sure = met.groupBy(key).agg(F.bool_or(~F.col("marginal")).alias("__any")).withColumnRenamed(key, "__k")
    met = met.join(sure, F.col(key) == F.col("__k")).where(~F.col("marginal") | ~F.col("__any"))
    # by name: a name that stands elsewhere on the scale brings that row along
    names = met.select(key, "name").distinct()
    rows = names.join(bounds, "name")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("at")).alias("p"), F.col("name").alias("n")))), lambda x: x["n"])
    got = rows.groupBy(key).agg(F.array_distinct(ordered).alias("__n"), F.max("older").alias("older"), F.min("younger").alias("younger"))
    first, last = F.get("__n", 0), F.element_at("__n", -1)
    got = got.withColumn("label", F.when(F.size("__n") > 1, F.concat_ws("-", first, last)).otherwise(first)).drop("__n").withColumnRenamed(key, "__k")
    return _outcomes(aged.join(got, F.col(key) == F.col("__k"), "left").drop("__k"), stage)


def _labelled(aged: DataFrame, bounds: list[Row]) -> DataFrame:
    """aged with older, younger and label by a short scale, row by row: no join and no shuffle."""
    kind = "array<struct<name:string,older:double,younger:double,error:double>>"
    rows = [F.struct(*(F.lit(b[c]).alias(c) for c in ("name", "older", "younger", "error"))) for b in sorted(bounds, key=lambda b: -b["at"])]
    scale = F.array(*rows).cast(kind)
    # generators, and lambdas over an array of one, keep what several places need from being computed in each
    once = lambda value, f: F.get(F.transform(F.array(value), f), 0)
    aged = aged.withColumn("__d", F.explode(F.array(F.struct("d_max", "d_min")))).drop("d_max", "d_min")
    high, low = F.col("__d.d_max"), F.col("__d.d_min")
    over = lambda s: F.round(F.least(high, s["older"]) - F.greatest(low, s["younger"]), 4)
    inside = lambda s: (high >= s["younger"] - s["error"]) & (high < s["older"] + s["error"])
    met = F.filter(scale, lambda s: high.isNotNull() & F.when(high == low, inside(s)).otherwise(over(s) > 0))
    sure = lambda m: F.filter(m, lambda s: (high == low) | (over(s) >= s["error"]))
    name = lambda rows: F.transform(rows, lambda s: s["name"])
    # by name: a name that stands elsewhere on the scale brings that row along
    same = lambda names: F.filter(scale, lambda s: F.array_contains(names, s["name"]))

    def told(rows: Column) -> Column:
        label = once(F.array_distinct(name(rows)), lambda n: F.when(F.size(n) > 1, F.concat_ws("-", F.get(n, 0), F.element_at(n, -1))).otherwise(F.get(n, 0)))
        older, younger = F.array_max(F.transform(rows, lambda s: s["older"])), F.array_min(F.transform(rows, lambda s: s["younger"]))
        return F.struct(label.alias("label"), older.alias("older"), younger.alias("younger"))

    kept = once(met, lambda m: once(sure(m), lambda u: F.when(F.size(u) > 0, name(u)).otherwise(name(m))))
    aged = aged.withColumn("__r", F.explode(F.array(once(kept, lambda names: once(same(names), told)))))
    return aged.withColumns({"d_max": high, "d_min": low, **{c: F.col(f"__r.{c}") for c in ("older", "younger", "label")}}).drop("__d", "__r")


def _outcomes(out: DataFrame, stage: str) -> DataFrame:
    plain = lambda c: F.lower(F.replace(c, F.lit("-"), F.lit(" ")))
    equal = plain(F.col("label")) == plain(F.coalesce(F.col(stage), F.lit("-")))
    outcome = F.when(F.col("d_max").isNull(), "SKIP").when(F.col("label").isNull(), "OUT_OF_BOUNDS").when(equal, "OK").otherwise("FIX")
    out = out.withColumn("outcome", outcome)
    return out.withColumn(stage, F.when(F.col("outcome") == "FIX", F.col("label")).otherwise(F.col(stage)))
