"""Which landed page answers for a name, and why others don't; what a page says about older names and its scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.functions.html import parse
from basalt.functions.text import MISSING

# Words that begin a note, not a name.
NOTE_WORDS = ("see", "main", "additional", "list")
# End of fixed values.


def bare_title(title: Column) -> Column:
    """Lower case, without daggers and what stands in brackets."""
    return F.trim(F.lower(F.regexp_replace(F.replace(title, F.lit("†"), F.lit("")), r"\s*\(.*?\)", "")))


def page_outcome(name: Column, suffix: Column, title: Column, has_infobox: Column) -> Column:
    """REDIRECT if the title's first word is another name, NO_INFOBOX, ALIAS if found under a suffix or another title, else OK.
    A page without a title isn't compared."""
    other = F.get(F.split(bare_title(title), r"\s+"), 0) != bare_title(name)
    alias = (suffix != "") | (F.lower(F.trim(F.replace(title, F.lit("†"), F.lit("")))) != F.lower(name))
    return F.when(F.coalesce(other, F.lit(False)), "REDIRECT").when(~has_infobox, "NO_INFOBOX").when(F.coalesce(alias, F.lit(False)), "ALIAS").otherwise("OK")


def scope_outcome(clade: Column, lineage: Column, failed: Column) -> Column:
    """NO_CLADE, OUT_OF_SCOPE when the lineage lacks the start node (is empty), UNKNOWN when it couldn't be read (such pages
    are kept), else IN_SCOPE."""
    return (
        F.when(clade.isNull() | (clade == MISSING), "NO_CLADE").when(failed | lineage.isNull(), "UNKNOWN").when(F.size(lineage) == 0, "OUT_OF_SCOPE").otherwise("IN_SCOPE")
    )


def refine_clade(clade: Column, lineage: Column) -> Column:
    """'Incertae sedis' is a state, not a group: the last proper name of the lineage stands for it."""
    proper = F.filter(lineage, lambda x: ~F.lower(x).contains("incertae"))
    last = F.when(F.size(proper) > 0, F.element_at(proper, -1))
    return F.when(F.lower(clade).contains("incertae"), F.coalesce(last, clade)).otherwise(clade)


def old_name(html: str | None) -> str | None:
    """All italic words of an item, as one name."""
    words = " ".join(i.text() for i in parse(html).all("i")).replace("†", "").replace("?", "").split()
    return " ".join(words) or None


def is_historical(name: Column, genus: Column) -> Column:
    """Whether an old name begins with another genus, written out."""
    first = F.get(F.split(name, " "), 0)
    short = (F.length(first) <= 2) & first.endswith(".")
    return F.coalesce(first.rlike(r"^\p{Lu}") & (F.lower(first) != F.lower(genus)) & ~short & ~F.lower(first).isin(*NOTE_WORDS), F.lit(False))


def migrations(names: DataFrame) -> DataFrame:
    """(pos, old_name, new_genus) of (pos, name, genus): the first genus that each historical name was met with."""
    met = names.where(is_historical(F.col("name"), F.col("genus")))
    return met.groupBy("name").agg(F.min_by(F.struct("pos", "genus"), "pos").alias("r")).select("r.pos", F.col("name").alias("old_name"), F.col("r.genus").alias("new_genus"))


def status_bucket(status: Column) -> Column:
    """The report section of a genus's status: the first that fits."""
    out = F.when(status == "valid", "valid").otherwise("other")
    for word in ("preoccupied", "nudum", "synonym"):
        out = F.when(status.contains(word), word).otherwise(out)
    return out


def report(rows: DataFrame, section: str = "section", entry: str = "entry") -> DataFrame:
    """(section, n, entries): counts and sorted entries. A report is read by people; entries are as many as rows."""
    return rows.groupBy(section).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(entry)).alias("entries"))


def totals(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    """(suspicious, total): pages with no record, without an infobox or out of scope, and all of them."""
    suspicious = F.col(outcome).isin("ZERO", "NO_INFOBOX", "OUT_OF_SCOPE")
    return rows.agg(F.count_if(suspicious).alias("suspicious"), F.count("*").alias("total"))


def outcomes(stages: dict[str, DataFrame], outcome: str = "outcome") -> DataFrame:
    """(stage, outcome, n): every stage's outcomes, counted."""
    out = None
    for name, df in stages.items():
        one = df.groupBy(F.col(outcome).alias("outcome")).agg(F.count("*").alias("n")).select(F.lit(name).alias("stage"), "outcome", "n")
        out = one if out is None else out.unionByName(one)
    return out
