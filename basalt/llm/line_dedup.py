"""Line dedup by winnowing over line hashes.

A window is the shortest run of lines with a word, from any of them on, that has ``min_lines`` lines or ``min_words`` words.
Where windows end depends on what follows alone, so equal runs have equal windows wherever they stand. Each window selects the
position of its least line hash (the last one of equals); neighbouring windows mostly select the same, so there are about half
as many positions as lines. The hash is the position's fingerprint: two runs with a common window share one for sure.

1. Positions are counted by fingerprint, and those whose fingerprint stands at one position only go.
2. At each other position the windows that selected it are the seeds. A seed is joined with the first place, in the order of
   (id, row, line), that holds the same lines, as 128 bits of SHA-256 of the text tell.
3. Matches are extended. A window ends no later than the next one, so backwards each line that agrees begins a seed that
   matches too; forwards up to ``min_lines - 1`` lines are left, which are compared line by line with those at the first place.
   Matches that overlap or touch are united, and all runs but those of the first place are deleted.

First places are found by an aggregation that combines before it shuffles, and the joins by fingerprint and by window split
hot keys off, so a line or a text that stands in a third of the rows is no hot group: nothing lists or pairs positions.

Defined cases: a null text counts as empty and comes back empty; lines without a word never start or end a window, and go
with a run that spans them; a line that repeats back to back collapses to its first; rows alike in id go by their place in the
table; null ids sort first. Columns named like an output are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import WORD, join_split, materialize, read_table, shield

MIN_LINES = 3
MIN_WORDS = 50
_NONE = "array<struct<s:int,e:int>>"


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def _digest(x: Column) -> Column:
    """The first 128 bits of SHA-256."""
    return F.unhex(F.substring(F.sha2(x, 256), 1, 32))


def _windows(text: Column, min_lines: int, min_words: int) -> Column:
    """array<struct<s, e, p, f, g, next>>: first and last line, the selected line and its hash, digest of all lines' digests,
    and the next ``min_lines - 1`` lines with a word (line and digest; null behind the text's end)."""
    line = lambda x, i: F.struct(
        i.alias("i"), F.xxhash64(x).alias("h"), _digest(x).alias("d"), F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("n")
    )
    lines = F.filter(F.transform(F.split(text, "\n"), line), lambda x: x["n"] > 0)

    def window(a: Column, x: Column, j: Column) -> Column:
        words, out = x["n"], None
        part = [x] + [F.get(a, j + k) for k in range(1, min_lines)]
        for k in range(min_lines):
            if k:
                words = words + part[k]["n"]
            at = part[: k + 1]
            least = F.least(*(y["h"] for y in at)) if k else x["h"]
            place = at[0]["i"]
            for y in at[1:]:
                place = F.when(y["h"] == least, y["i"]).otherwise(place)
            whole = _digest(F.concat(*(y["d"] for y in at))) if k else x["d"]
            made = F.struct(
                x["i"].alias("s"), at[k]["i"].alias("e"), place.alias("p"), least.alias("f"), whole.alias("g"),
                _next(a, j + k, min_lines - 1).alias("next"),
            )
            ends = (words >= min_words) if k < min_lines - 1 else at[k].isNotNull()
            out = F.when(ends, made) if out is None else out.when(ends, made)
        return out

    return F.filter(_bind(lines, lambda a: F.transform(a, lambda x, j: window(a, x, j))), lambda w: w.isNotNull())


def _next(a: Column, j: Column, n: int) -> Column:
    """The n lines behind the j-th one of a."""
    none = F.array().cast("array<struct<i:int,d:binary>>")
    at = [F.get(a, j + k) for k in range(1, n + 1)]
    return F.array(*(F.when(x.isNotNull(), F.struct(x["i"].alias("i"), x["d"].alias("d"))) for x in at)) if n else none


def _positions(windows: Column) -> Column:
    """array<struct<p, f, seeds>>: the selected positions in order, each with the windows that selected it."""

    def group(a: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda j: (j == 0) | (F.get(a, j)["p"] != F.get(a, j - 1)["p"]))
        one = lambda o, j, k: F.struct(
            F.get(a, j)["p"].alias("p"), F.get(a, j)["f"].alias("f"), F.slice(a, j + 1, F.coalesce(F.get(o, k + 1), F.size(a)) - j).alias("seeds")
        )
        return F.when(F.size(a) > 0, _bind(first, lambda o: F.transform(o, lambda j, k: one(o, j, k))))

    return _bind(windows, group)


def _extended(e: Column, own: Column, first: Column, n: int) -> Column:
    """The last line of a window that ends at e, and goes on while the next lines agree with the first place's."""
    out, agree = e, F.lit(True)
    for k in range(n):
        agree = agree & F.coalesce(own[k]["d"] == first[k]["d"], F.lit(False))
        out = F.when(agree, own[k]["i"]).otherwise(out)
    return out


def repeated_runs(rows: DataFrame, id_col: str, text_col: str, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(__row, s, e): the extended matches of rows, a written table whose column __row numbers its rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = rows.select(F.col(id_col).alias("id"), "__row", F.explode(_positions(_windows(text, min_lines, min_words))).alias("w"))
    prints = materialize(made.select("id", "__row", "w.p", "w.f", "w.seeds"), "line-prints")
    shared = materialize(prints.groupBy("f").agg(F.count("*").alias("n")).where("n > 1"), "line-shared")
    seeds = join_split(prints, shared, "f").select("id", "__row", F.explode("seeds").alias("w")).select("id", "__row", "w.s", "w.e", "w.g", "w.next")
    seeds = materialize(seeds, "line-seeds")
    place = F.struct("id", "__row", "s")
    first = seeds.groupBy("g").agg(F.min(F.struct(place.alias("at"), "next")).alias("first"), F.count("*").alias("n")).where("n > 1")
    found = join_split(seeds, materialize(first, "line-first"), "g").where(place > F.col("first.at"))
    return found.select("__row", "s", _extended(F.col("e"), F.col("next"), F.col("first.next"), min_lines - 1).alias("e"))


def line_dedup(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = MIN_LINES, min_words: int = MIN_WORDS
) -> DataFrame:
    """df with repeated runs taken out of the text, and n_lines, n_removed (long) and removed, the runs as
    ``first-last`` line numbers from 0, joined by commas."""
    df, restore = shield(df)
    # written, so that a row has the same number whenever it is read
    rows = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "line-rows")
    found = repeated_runs(rows, id_col, text_col, min_lines, min_words)
    found = found.groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("__found"))
    out = rows.join(found, "__row", "left").withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    # an extended match may reach past the end of later ones, of up to 2 * min_lines - 3
    reach = lambda a, x, j: F.greatest(x["e"], *(F.get(a, j - k)["e"] for k in range(1, 2 * min_lines)))
    spread = lambda a: F.transform(a, lambda x, j: F.struct(x["s"].alias("s"), reach(a, x, j).alias("e")))

    def unite(w: Column) -> Column:
        opens = F.filter(w, lambda x, j: (j == 0) | (x["s"] > F.get(w, j - 1)["e"] + 1))
        ends = F.filter(w, lambda x, j: (j == F.size(w) - 1) | (F.get(w, j + 1)["s"] > x["e"] + 1))
        return F.zip_with(opens, ends, lambda a, b: F.struct(a["s"].alias("s"), b["e"].alias("e")))

    runs = F.when(F.col("__found").isNotNull(), _bind(_bind(F.col("__found"), spread), unite)).otherwise(F.array().cast(_NONE))
    out = out.withColumn("__runs", runs).withColumn("__lines", F.split("__text", "\n"))
    n = F.size("__runs")

    def between(k: Column) -> Column:
        a = F.when(k == 0, F.lit(0)).otherwise(F.get(F.col("__runs"), k - 1)["e"] + 1)
        b = F.when(k == n, F.size("__lines")).otherwise(F.get(F.col("__runs"), k)["s"])
        return F.slice("__lines", a + 1, b - a)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), between)), "\n")
    removed = F.aggregate("__runs", F.lit(0), lambda a, r: a + r["e"] - r["s"] + 1).cast("long")
    out = out.withColumns(
        {
            text_col: F.when(n == 0, F.col("__text")).otherwise(kept),
            "n_lines": F.size("__lines").cast("long"),
            "n_removed": removed,
            "removed": F.array_join(F.transform("__runs", lambda r: F.concat_ws("-", r["s"].cast("string"), r["e"].cast("string"))), ","),
        }
    )
    return restore(out.drop("__row", "__text", "__found", "__runs", "__lines"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "removed", F.sha2("text", 256).alias("clean_sha256"))


#: Runs to delete over a relation ``ld(rid, doc_id, text)``; leaves ``kept_text(rid, text, n_lines, n_removed, removed)``.
DEDUP_SQL = rf"""
l0 AS (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM ld),
lw AS (SELECT *, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n FROM l0),
l1 AS (SELECT *, row_number() OVER o AS k, lead(l, 1) OVER o AS l2, lead(l, 2) OVER o AS l3, lead(i, 1) OVER o AS i2, lead(i, 2) OVER o AS i3, lead(n, 1) OVER o AS n2
    FROM lw WHERE n > 0 WINDOW o AS (PARTITION BY rid ORDER BY i)),
win AS (SELECT rid, doc_id, i AS s, k, CASE WHEN n >= {MIN_WORDS} THEN k WHEN n + n2 >= {MIN_WORDS} THEN k + 1 ELSE k + 2 END AS ke,
    CASE WHEN n >= {MIN_WORDS} THEN i WHEN n + n2 >= {MIN_WORDS} THEN i2 ELSE i3 END AS e,
    CASE WHEN n >= {MIN_WORDS} THEN l WHEN n + n2 >= {MIN_WORDS} THEN l || chr(10) || l2 ELSE l || chr(10) || l2 || chr(10) || l3 END AS g FROM l1),
nth AS (SELECT *, row_number() OVER o AS nth, first_value(rid) OVER o AS frid, first_value(ke) OVER o AS fke FROM win WHERE e IS NOT NULL
    WINDOW o AS (PARTITION BY g ORDER BY doc_id NULLS FIRST, rid, s ROWS UNBOUNDED PRECEDING)),
rep AS (SELECT nth.rid, nth.s, CASE WHEN a1.l = b1.l AND a2.l = b2.l THEN a2.i WHEN a1.l = b1.l THEN a1.i ELSE nth.e END AS e FROM nth
    LEFT JOIN l1 a1 ON a1.rid = nth.rid AND a1.k = nth.ke + 1 LEFT JOIN l1 b1 ON b1.rid = nth.frid AND b1.k = nth.fke + 1
    LEFT JOIN l1 a2 ON a2.rid = nth.rid AND a2.k = nth.ke + 2 LEFT JOIN l1 b2 ON b2.rid = nth.frid AND b2.k = nth.fke + 2 WHERE nth.nth > 1),
gone AS (SELECT DISTINCT l0.rid, l0.i FROM l0 JOIN rep ON l0.rid = rep.rid AND l0.i BETWEEN rep.s AND rep.e),
isl AS (SELECT rid, min(i) AS s, max(i) AS e FROM (SELECT rid, i, i - row_number() OVER (PARTITION BY rid ORDER BY i) AS island FROM gone) GROUP BY rid, island),
runs AS (SELECT rid, string_agg(s || '-' || e, ',' ORDER BY s) AS removed FROM isl GROUP BY rid),
kept_text AS (SELECT l0.rid, coalesce(string_agg(l0.l, chr(10) ORDER BY l0.i) FILTER (gone.i IS NULL), '') AS text, count(*) AS n_lines,
    count(gone.i) AS n_removed, coalesce(any_value(runs.removed), '') AS removed
    FROM l0 LEFT JOIN gone ON l0.rid = gone.rid AND l0.i = gone.i LEFT JOIN runs ON l0.rid = runs.rid GROUP BY l0.rid)"""

OP4_SQL = rf"""WITH ld AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),{DEDUP_SQL}
SELECT doc_id, k.n_lines, k.n_removed, k.removed, sha256(k.text) AS clean_sha256 FROM ld JOIN kept_text k USING (rid)"""
