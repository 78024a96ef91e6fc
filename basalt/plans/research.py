"""The research pipeline over landed pages: lists, time scale, articles, merge, validation, ages, paths, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basalt.functions import html, text
from basalt.operators.audit import history_entries, next_tombstones, snapshot_diff
from basalt.operators.hierarchy import prefixes, render
from basalt.operators.interval import assign_stages
from basalt.operators.merge import merge_records, page_skips
from basalt.operators.ordering import keep_first, numbered, run_dedup
from basalt.operators.pages import page_outcome, refine_clade, scope_outcome
from basalt.operators.validate import resolve_status
from basalt.storage import materialize

# Where pages are cut, and the suffixes of a page's candidates, in order.
LIST_MARKS = ('id="A"', 'id="See_also"')
SUFFIXES = ("", "_(dinosaur)", "_(reptile)", "_(archosaur)")
# End of fixed values.


def only_listed(rows: DataFrame, only: DataFrame | None) -> DataFrame:
    """rows whose genus ``only`` (name) lists, ignoring case; all if it lists none."""
    if only is None or only.isEmpty():
        return rows
    return rows.join(only.select(F.lower("name").alias("__n")).distinct(), F.lower("genus") == F.col("__n"), "left_semi")


def candidates(genera: DataFrame, base: str = "") -> DataFrame:
    """genera with each page it may have, in order: k, suffix, title and url."""
    asked = genera.select("*", F.posexplode(F.array(*map(F.lit, SUFFIXES))).alias("k", "suffix"))
    asked = asked.withColumn("title", F.concat(F.translate("genus", " ", "_"), "suffix"))
    return asked.withColumn("url", F.concat(F.lit(base), "title"))


def genera_list(pages: DataFrame, only: DataFrame | None = None, html_col: str = "html") -> DataFrame:
    """(pos, genus, status) from list pages (pos, html): the first of each name; ``only`` (name) keeps the names it lists, if it
    lists any."""
    part = text.slice_page(F.col(html_col), *LIST_MARKS)
    blocks = pages.select("pos", F.posexplode(F.split(part, "<li>")).alias("i", "block")).where(F.trim("block") != "")
    head = text.block_head(F.col("block"))
    rows = blocks.select("pos", "i", text.first_name(head).alias("genus"), text.after_dash(text.strip_tags(head)).alias("about"))
    rows = rows.where(F.col("genus").isNotNull() & (F.length("genus") >= 2) & ~F.col("genus").isin(*text.STOP_NAMES))
    rows = only_listed(rows, only)
    rows = rows.withColumn("status", text.status_of(F.col("about")))
    first = keep_first(rows.select("genus", "status", "pos", "i"), ["genus"], ["pos", "i"])
    return first.select(F.struct("pos", "i").alias("pos"), "genus", "status")


def time_scale(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(pos, eon, era, period, epoch, stage, start_ma, uncertainty) from the page (page_id, html) that holds the scale."""
    rows = pages.select("page_id", F.posexplode(html.table_grid_udf(html_col)).alias("pos", "g"))
    cell = lambda i: F.get("g", i)
    rows = rows.where(cell(0).isNotNull() & ~cell(0).contains("Eonothem"))
    name = lambda i: F.when(text.is_clean_name(cell(i)), text.clean_geo_name(cell(i))).otherwise(text.MISSING)
    age = F.translate(F.when(F.coalesce(cell(6), F.lit("")).rlike(r"\d"), cell(6)).otherwise(F.concat_ws(" ", "g")), ",", "")
    rows = rows.select("page_id", "pos", *(name(i).alias(c) for i, c in enumerate(("eon", "era", "period", "epoch", "stage"))), text.first_number(age).alias("start_ma"), text.uncertainty(age).alias("uncertainty"))
    rows = rows.withColumns(text.blank_hierarchy(F.col("era"), F.col("period"), F.col("epoch"), F.col("stage")))
    rows = rows.where(~F.col("stage").isin("Stage / Age", "Stage", "Age") & ~((F.col("eon") == "-") & (F.col("era") == "-") & (F.col("stage") == "-")))
    return run_dedup(rows, ["page_id"], ["pos"], ["stage", "start_ma"])


def first_pages(genera: DataFrame, pages: DataFrame) -> DataFrame:
    """(genus, pos, status, title, html, outcome): each genus's first page that answers for it among its candidates (title, html);
    where none does, the last one with what is wrong with it (REDIRECT, NO_INFOBOX), or NOT_FOUND without a page.

    A genus without a page, a page without a heading or html, and an empty table of either are no errors."""
    met = candidates(genera).join(pages.select("title", "html"), "title")
    # a page's own markup tells its class; the parser reads only pages that answer
    box = F.coalesce(F.col("html").rlike(r"(?i)<table[^>]*class\s*=\s*[\"']?[^\"'>]*infobox"), F.lit(False))
    found = page_outcome(F.col("genus"), F.col("suffix"), html.title_udf("html"), box)
    met = met.withColumn("outcome", found).withColumn("answers", F.col("outcome").isin("OK", "ALIAS"))
    row = F.struct("title", "html", "outcome")
    best = met.groupBy("genus").agg(F.coalesce(F.min_by(F.when(F.col("answers"), row), F.when(F.col("answers"), F.col("k"))), F.max_by(row, "k")).alias("r"))
    out = genera.select("genus", "pos", "status").join(best, "genus", "left")
    return out.select("genus", "pos", "status", "r.title", "r.html", F.coalesce("r.outcome", F.lit("NOT_FOUND")).alias("outcome"))


def scoped(read: DataFrame, taxonomy: DataFrame, start: str) -> DataFrame:
    """read (with clade and genus) with its clade's lineage from the start node on, the clade refined by it, and scope (see
    scope_outcome). A clade's page is the first of its candidates in taxonomy (title, html); without one its scope is unknown."""
    clades = read.where(F.col("clade") != text.MISSING).select(F.col("clade").alias("genus")).distinct()
    met = candidates(clades).join(taxonomy.select("title", "html"), "title")
    pages = met.groupBy("genus").agg(F.min_by("html", "k").alias("__page")).withColumn("lineage", html.lineage_udf("__page", F.lit(start), F.lit("")))
    out = read.join(pages.select(F.col("genus").alias("clade"), "lineage"), "clade", "left")
    # the clade itself ends its lineage
    until = F.array_position("lineage", F.col("clade")).cast("int")
    line = F.when(until > 0, F.slice("lineage", 1, F.greatest(until - 1, F.lit(0)))).otherwise(F.col("lineage"))
    out = out.withColumn("scope", scope_outcome(F.col("clade"), F.col("lineage"), F.col("lineage").isNull() & (F.col("clade") != text.MISSING)))
    return out.withColumn("lineage", line).withColumn("clade", refine_clade(F.col("clade"), F.col("lineage")))


def articles_of(genera: DataFrame, pages: DataFrame, taxonomy: DataFrame | None = None, start: str = "Dinosauria") -> DataFrame:
    """first_pages of genera with ``a``, what their articles hold, the clade's lineage and scope; out of scope, or without a
    clade, the outcome is that."""
    read = first_pages(genera, pages).withColumn("a", F.when(F.col("outcome").isin("OK", "ALIAS"), html.article_udf("html")))
    read = read.withColumn("clade", F.coalesce("a.clade", F.lit(text.MISSING)))
    if taxonomy is None:
        return read.withColumns({"lineage": F.array().cast("array<string>"), "scope": F.lit("UNKNOWN")})
    read = scoped(read, taxonomy, start)
    bad = F.col("outcome").isin("OK", "ALIAS") & F.col("scope").isin("OUT_OF_SCOPE", "NO_CLADE")
    return read.withColumn("outcome", F.when(bad, F.col("scope")).otherwise(F.col("outcome")))


def fauna(genera: DataFrame, read: DataFrame) -> DataFrame:
    """Merged records of the articles read; a genus that is a nomen nudum gives a stub, and its page isn't read."""
    bare = genera.where(F.col("status").contains("nudum"))
    read = read.where(F.col("outcome").isin("OK", "ALIAS"))
    span = text.certain_part(F.col("a.range_text"))
    dash = lambda c: F.coalesce(c, F.lit("-"))
    rows = read.select("pos", F.col("genus").alias("source_genus"), "clade", dash(text.stage_range(span)).alias("stage"), dash(text.age_range(span)).alias("age"), F.posexplode("a.records").alias("i", "r"))
    rows = rows.select("pos", "i", "source_genus", "clade", "stage", "age", "r.*")
    stub = bare.select("pos", F.lit(0).alias("i"), F.col("genus").alias("source_genus"), *(F.lit("-").alias(c) for c in ("clade", "stage", "age")), F.lit(0).alias("section"), "genus", F.lit("-").alias("species"), "status", F.lit(False).alias("is_type"), F.lit("-").alias("author"), F.lit("-").alias("year"))
    arrival = F.struct("pos", "section", "i")
    every = rows.unionByName(stub).select(arrival.alias("arrival"), "*").drop("pos", "i")
    # a number for each arrival: the fold and the merge need a plain one
    every = numbered(every, ["arrival"], "pos").drop("arrival").withColumn("page", F.col("source_genus"))
    kept = page_skips(every).where("outcome <> 'skipped'").drop("outcome")
    # a page's only main record is its type; stubs aren't
    only = F.count(F.when((F.col("section") == 0) & (F.col("species") != "-"), 1)).over(Window.partitionBy("page")) == 1
    kept = kept.withColumn("is_type", F.coalesce("is_type", F.lit(False)) | (only & (F.col("section") == 0) & (F.col("species") != "-")))
    kept = kept.drop("page", "section").withColumns({"gk": F.lower("genus"), "sk": F.lower("species")})
    return merge_records(kept, ["gk", "sk"]).drop("gk", "sk")


def audit_facts(rows: DataFrame) -> DataFrame:
    """(page, species, value): a page's own fact (species null) and one for each of its records; values are joined by bars. Stubs
    have no page, so no facts."""
    rows = rows.where(F.col("species") != text.MISSING)
    own = rows.groupBy(F.col("source_genus").alias("page")).agg(F.min(F.struct("clade", "age", "stage")).alias("r"))
    own = own.select("page", F.lit(None).cast("string").alias("species"), text.fact_value(*(F.col("r")[c] for c in ("clade", "age", "stage"))).alias("value"))
    each = rows.select(F.col("source_genus").alias("page"), "species", text.fact_value("status", "is_type", "author", "year", "source_genus").alias("value"))
    return own.unionByName(each)


def audit_run(facts: DataFrame, before: DataFrame, tombstones: DataFrame, first_run: bool) -> dict[str, DataFrame]:
    """What changed since the last run's facts, the next registry of lost names, and the history's new lines."""
    diff = snapshot_diff(before, facts, tombstones, first_run)
    return {"diff": diff, "tombstones": next_tombstones(diff, tombstones), "history": history_entries(diff, first_run)}


def research(
    list_pages: DataFrame, scale_pages: DataFrame, articles: DataFrame, only: DataFrame | None = None, taxonomy: DataFrame | None = None, start: str = "Dinosauria",
    before: DataFrame | None = None, tombstones: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The run's tables: genera, scale, outcomes of their pages, final fauna with both stages' outcomes, paths (node, path) of the
    lineages in scope, and the facts; with the last run's facts (``before``) and tombstones also what the audit finds.

    Scope is checked where taxonomy pages are given. Every input may be empty."""
    genera, scale = genera_list(list_pages, only), time_scale(scale_pages)
    named = ~F.col("status").contains("nudum")
    # read once: pages are parsed here
    read = materialize(articles_of(genera.where(named), articles, taxonomy, start), "articles")
    outcomes = read.select("genus", "outcome").union(genera.where(~named).select("genus", F.lit("STUB")))
    valid = resolve_status(fauna(genera, read), genera).withColumnRenamed("outcome", "status_outcome")
    final = assign_stages(valid, scale.withColumn("pos", F.col("pos").cast("long")), key="pos").withColumnRenamed("outcome", "stage_outcome")
    final = materialize(final, "fauna")
    line = F.concat("lineage", F.array("clade"))
    lines = read.where(F.col("outcome").isin("OK", "ALIAS") & (F.col("scope") == "IN_SCOPE")).select(F.col("genus").alias("source"), "pos", line.alias("lineage"))
    paths = prefixes(lines).select("node", render(F.col("path"), F.col("node")).alias("path"))
    facts = audit_facts(final)
    out = {"genera": genera, "scale": scale, "outcomes": outcomes, "fauna": final, "paths": paths, "facts": facts}
    if before is not None:
        out |= audit_run(facts, before, tombstones if tombstones is not None else before.select(F.lit("").alias("name")).limit(0), False)
    return out
