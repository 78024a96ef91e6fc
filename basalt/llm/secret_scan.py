"""Secret scans: three fixed patterns, and character Markov models for strings no pattern names.

Two first-order models over the characters of ``[A-Za-z0-9+/_=-]`` are trained from labelled samples, one of random
strings and one of ordinary identifiers. Runs of such characters are looked for in what the fixed patterns' matches leave of
the text, so what stands beside a match is scored by itself; a run of at least ``min_run`` is reported when the log-likelihood
ratio of the two models is above ``min_llr``.

The scan is one expression over each row and shuffles nothing. Places come from running sums in chunks, and pieces are cut out
of blocks, so a text's time grows with its length and its number of matches, not with their product. The models are
2 x 66 x 66 counts, gathered by an aggregation whose result has that many rows at most, however many samples there are.

Defined cases: a null text counts as empty and has no spans; spans are counted in code points, end exclusive; a span may
lie inside another of another fixed kind, and both are reported; repeated rows are scanned each on its own; columns named
like an output are replaced, all others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import read_table, shield

#: Fixed patterns, in the order in which spans with equal starts are listed.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Runs below 24 characters would be dropped, and runs are whole either way.
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MIN_RUN = 20
#: Natural-log units in favour of the random model.
MIN_LLR = 8.0
#: Documents (in expectation) of whose words ordinary identifiers are made, and numbers of which random strings are.
SAMPLE_DOCS = 1000
SAMPLE_RANDOM = 4000
#: Whole runs of the alphabet that count as plain words.
PLAIN_WORD = "^[A-Z]?[a-z]{1,14}$"
#: Elements that a running sum copies at once, and code points of the blocks that pieces are cut from.
CHUNK = 128
BLOCK = 4096


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def _before(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array, op over 0 and all that stand before it: within chunks, and over the chunks' totals."""
    grow = lambda acc, x: F.concat(acc, F.array(op(F.element_at(acc, -1), x)))

    def within(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), op))
        carried = F.slice(F.aggregate(totals, F.array(F.lit(0)), grow), 1, F.size(chunks))
        return F.flatten(F.zip_with(chunks, carried, lambda c, z: F.slice(F.aggregate(c, F.array(z), grow), 1, F.size(c))))

    def whole(a: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int"))
        chunks = F.transform(at, lambda i: F.slice(a, i * CHUNK + 1, F.lit(CHUNK)))
        return F.when(F.size(a) > 0, _bind(chunks, within)).otherwise(F.array().cast("array<int>"))

    return _bind(values, whole)


def _spans(text: Column, pattern: str, kind: int, gate: Column, least: int, group: int = 0) -> Column:
    """array<struct<s, k, e, t>> of the leftmost non-overlapping matches whose group has at least ``least`` code points.

    split() gives the pieces between matches, so sums of lengths give places."""
    full = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)) if group else None

    def place(m: Column) -> Column:
        gaps = F.transform(F.slice(m["p"], 1, F.size(m["m"])), lambda x: F.length(x))
        starts = _before(F.zip_with(gaps, m["m"], lambda g, x: g + F.length(x)), lambda a, b: a + b)
        starts = F.zip_with(starts, gaps, lambda a, g: a + g)
        one = lambda s, x: F.struct(s.alias("s"), F.lit(kind).alias("k"), (s + F.length(x)).alias("e"), x.alias("t"))
        found = F.zip_with(starts, m["m"], one)
        return F.filter(found, lambda x, i: (F.get(m["v"], i) if group else F.length(x["t"])) >= least)

    parts = [F.split(text, pattern, -1).alias("p"), full.alias("m")] + ([sizes.alias("v")] if group else [])
    return F.when(gate, _bind(F.struct(*parts), place)).otherwise(F.array().cast("array<struct<s:int,k:int,e:int,t:string>>"))


def _places(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))


def _replaced(text: Column, spans: Column, mark: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with mark(span's number, span, end of what came before) in place of united spans, sorted by start."""

    def build(h: Column) -> Column:
        spans, reach, blocks = h["spans"], h["reach"], h["blocks"]

        def cut(a: Column, b: Column) -> Column:
            i = F.floor(a / BLOCK).cast("int")
            near = F.array_join(F.slice(blocks, i + 1, F.floor(b / BLOCK).cast("int") - i + 1), "")
            return F.when(b > a, F.substring(near, a - i * BLOCK + 1, b - a)).otherwise("")

        one = lambda x, j: F.concat(cut(F.get(reach, j), x["s"]), mark(j, x, F.get(reach, j)))
        end = F.greatest(F.element_at(reach, -1), F.element_at(spans, -1)["e"])
        return F.concat(F.array_join(F.transform(spans, one), ""), cut(end, F.length(text)))

    ends = _before(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    made = _bind(F.struct(spans.alias("spans"), ends.alias("reach"), blocks.alias("blocks")), build)
    return F.when(F.size(spans) > 0, made).otherwise(text)


def base_spans(text: Column) -> Column:
    """The fixed patterns' spans, by start, then kind."""
    low = F.lower(text)
    named = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("apikey") | low.contains("api_key")
    found = F.concat(
        _spans(text, ASSIGN, 0, named, 6, 2),
        _spans(text, ACCESS, 1, text.contains("AKIA"), 20),
        _spans(text, HEX, 2, text.rlike(HEX), 24),
    )
    return F.array_sort(_places(found))


def train_markov(samples: DataFrame, text_col: str = "s", label_col: str = "is_random") -> list[float]:
    """Log-likelihood ratios, random over ordinary, by 66 * first + second character; add-a-half smoothed.

    samples: one row for each string. Characters outside the alphabet end a transition. Empty samples give ratios of 0."""
    n = len(ALPHABET)
    at = lambda i: f"instr('{ALPHABET}', substring(t, {i}, 1)) - 1"
    pairs = samples.where(F.length(text_col) > 1).select(
        F.col(label_col).alias("r"),
        F.col(text_col).alias("t"),
        F.explode(F.sequence(F.lit(1), F.length(text_col) - 1)).alias("i"),
    )
    pairs = pairs.select("r", F.expr(at("i")).alias("a"), F.expr(at("i + 1")).alias("b"))
    rows = pairs.where("a >= 0 and b >= 0").groupBy("r", "a", "b").count().collect()
    count = {True: [0.5] * (n * n), False: [0.5] * (n * n)}
    for r in rows:
        count[bool(r["r"])][r["a"] * n + r["b"]] += r["count"]
    out = []
    for i in range(n):
        sums = {k: sum(v[i * n : (i + 1) * n]) for k, v in count.items()}
        for j in range(n):
            x = {k: math.log(v[i * n + j] / sums[k]) for k, v in count.items()}
            out.append(round(x[True] - x[False], 4))
    return out


def labelled_samples(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(s, is_random), each with its label by the way it is made. Random strings are digests of numbers (base64, hex of both
    cases, capitals with digits). Ordinary identifiers are three neighbouring plain words of a document, joined in the ways
    identifiers and paths are, so that an unnamed secret in a document is never taken for an ordinary one."""
    spark = docs.sparkSession
    d = F.sha2(F.col("id").cast("string"), 256)
    capitals = F.translate(F.upper(F.base64(F.unhex(d))), "+/=", "")
    made = F.array(F.regexp_replace(F.base64(F.unhex(d)), "=", ""), d, F.upper(F.substring(d, 1, 40)), capitals)
    random = spark.range(SAMPLE_RANDOM).select(F.explode(made).alias("s"), F.lit(True).alias("is_random"))
    total = max(1, docs.count())
    few = docs.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("markov")), F.lit(total)) < SAMPLE_DOCS)
    runs = F.regexp_extract_all(F.col(text_col), F.lit("[A-Za-z0-9+/_=-]+"), F.lit(0))
    words = few.select(F.filter(runs, lambda x: x.rlike(PLAIN_WORD)).alias("w")).where("size(w) >= 3")
    triple = F.transform(F.sequence(F.lit(0), F.floor(F.size("w") / 3).cast("int") - 1), lambda i: F.slice("w", 3 * i + 1, 3))
    words = words.select(F.explode(triple).alias("w")).distinct()
    low = F.transform("w", lambda x: F.lower(x))
    joined = lambda sep: F.array_join(low, sep)
    ways = [joined("_"), joined("-"), joined("/"), joined(""), F.upper(joined("_")), F.array_join(F.transform("w", lambda x: F.initcap(x)), "")]
    dated = F.concat(F.lit("/"), F.get(low, 0), F.lit("/"), (F.pmod(F.xxhash64("w"), F.lit(50)) + 1980).cast("string"), F.lit("/"), F.get(low, 1), F.lit("-"), F.get(low, 2))
    ways.append(dated)
    one = F.get(F.array(*ways), F.pmod(F.xxhash64(F.lit("way"), "w"), F.lit(len(ways))).cast("int"))
    return random.unionByName(words.select(one.alias("s"), F.lit(False).alias("is_random")))


def secret_scan(
    df: DataFrame, model: list[float], text_col: str = "text", min_run: int = MIN_RUN, min_llr: float = MIN_LLR
) -> DataFrame:
    """df with base_spans and spans (array<struct<s, k, e>>, k numbers KINDS) and masked_text."""
    df, restore = shield(df)
    text = F.coalesce(F.col(text_col), F.lit(""))
    run = rf"[A-Za-z0-9+/_=-]{{{min_run},}}"
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")  # folded into one literal
    n = len(ALPHABET)

    def llr(s: Column) -> Column:
        code = lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1
        codes = F.filter(F.transform(F.split(s, ""), code), lambda x: x >= 0)
        return _bind(codes, lambda a: F.aggregate(
            F.sequence(F.lit(0), F.size(a) - 2), F.lit(0.0), lambda t, i: t + F.get(table, F.get(a, i) * n + F.get(a, i + 1))
        ))

    # generators: what is above them doesn't compute them again
    df = df.withColumn("__base", F.explode(F.array(base_spans(text))))
    blank = _replaced(text, F.col("__base"), lambda j, x, before: F.repeat(F.lit(" "), F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], before))))
    runs = F.when(text.rlike(run), _bind(blank, lambda t: _spans(t, run, 3, F.lit(True), min_run)))
    hits = F.filter(runs, lambda r: llr(r["t"]) > min_llr)
    hits = F.coalesce(_places(hits), F.array().cast("array<struct<s:int,k:int,e:int>>"))
    df = df.withColumn("__all", F.explode(F.array(F.array_sort(F.concat("__base", hits)))))
    # spans that touch get one mark
    masked = _replaced(text, F.col("__all"), lambda j, x, before: F.when((j == 0) | (x["s"] > before), "[SECRET]").otherwise(""))
    out = df.withColumns({"base_spans": F.col("__base"), "spans": F.col("__all"), "masked_text": masked})
    return restore(out.drop("__base", "__all"))


def render(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan(docs, train_markov(labelled_samples(docs)))
    of = lambda k: F.size(F.filter("base_spans", lambda x: x["k"] == k)).cast("long")
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(render(F.col("base_spans")), 256).alias("base_sha256"),
        render(F.col("spans")).alias("spans"),
    )
