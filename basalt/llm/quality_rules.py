"""Line-first quality rules.

Every line of a text is judged on its own (punctuation, navigation, boilerplate); lines that fail are
removed, and a document that loses too much of its text that way, or fails the document rules, is rejected.

Everything is a DataFrame expression over one row, so there is no shuffle at all: a hot source, a copied
document or a very long text costs only the time its own characters take.

Defined cases: a null text counts as empty; an empty text has no words and is rejected; repeated rows are
judged each on its own; columns that are named like an output are replaced, all others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import SPACE, read_table, shield

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
#: A document goes when more than this share of its characters was in removed lines.
MAX_LOST_PCT = 50
SYMBOLS = "#*$%&|<>"
#: Positions take this many low bits beside a window's hash: as many as an array can have elements.
POSITION_BITS = 31

#: Sentence marks of the scripts in use; a line with none of them may be code, which a last mark of CODE_END tells.
MARKS = ".!?…。！？｡．।॥؟۔։።፧།។။᠃"
CODE_END = ";{}):"
#: Languages' phrases are parameters of quality_rules; these are the English ones.
NAVIGATION = (
    r"(?i)^\s*(home|menu|log ?in|log ?out|sign ?(in|up)|register|search|next|previous|back to top|skip to (main )?content"
    r"|read more|share( this)?|subscribe|contact( us)?|about( us)?|site ?map)\s*[.!>»|:]*\s*$"
)
BOILERPLATE = (
    r"(?i)(all rights reserved|terms (of (use|service)|and conditions)|privacy policy|cookie (policy|settings)"
    r"|use of cookies|enable javascript|lorem ipsum|powered by |click here|©)"
)


def has_mark(marks: str = MARKS, code_end: str = CODE_END) -> str:
    """A pattern of lines with a sentence mark, or that end as code does."""
    return rf"[{marks}]|[{code_end}][ \t\r]*\z"


def line_fails(line: Column, marks: str = MARKS, code_end: str = CODE_END, navigation: str = NAVIGATION, boilerplate: str = BOILERPLATE) -> Column:
    """True for a line that a rule removes.

    punctuation: no sentence mark and no end of code, a tenth of the characters are symbols, or marks doubled on every few words;
    navigation: three or more bars between short cells, or a lone menu phrase;
    boilerplate: a stock phrase in a line of up to 300 characters.
    """
    size = F.length(line)
    symbols = size - F.length(F.translate(line, SYMBOLS, ""))
    shouts = size - F.length(F.regexp_replace(line, "!!", "!"))
    bars = size - F.length(F.translate(line, "|»•", ""))
    no_mark = ~line.rlike(has_mark(marks, code_end))
    return (
        no_mark
        | (symbols * 10 > size)
        | ((shouts >= 3) & (shouts * 20 > size))
        | ((bars >= 3) & (bars * 40 > size))
        | ((size <= 60) & line.rlike(navigation))
        | ((size <= 300) & line.rlike(boilerplate))
    )


def _candidates(grams: Column) -> Column:
    """Positions of windows whose hash bits a neighbour in the sorted array has too, so of all that occur twice or more."""
    bits = lambda x: F.shiftright(x, POSITION_BITS)
    alike = lambda x, y: F.coalesce(bits(x) == bits(y), F.lit(False))
    near = F.filter(grams, lambda x, j: alike(x, F.get(grams, j - 1)) | alike(x, F.get(grams, j + 1)))
    return F.transform(near, lambda x: x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int"))


def _window(words: Column, p: Column) -> Column:
    return F.struct(*(F.get(words, p + k).alias(f"w{k}") for k in range(3)), p.alias("p"))


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows of three that occur twice or more: of the sorted windows and positions equal neighbours are
    found, and their positions are swept once."""

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["w0"] == y["w0"]) & (x["w1"] == y["w1"]) & (x["w2"] == y["w2"]), F.lit(False))

    twice = F.filter(windows, lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1)))
    hits = F.sort_array(F.transform(twice, lambda x: x["p"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last"))
    return F.aggregate(hits, start, step, lambda a: a["n"])


def quality_rules(
    df: DataFrame,
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_pct: int = MAX_REPEAT_PCT,
    max_lost_pct: int = MAX_LOST_PCT,
    marks: str = MARKS,
    code_end: str = CODE_END,
    navigation: str = NAVIGATION,
    boilerplate: str = BOILERPLATE,
) -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_bad_lines, lost_chars (long),
    clean_text, base_failed and kept. Marks are characters of a bracket expression; the last two are patterns."""
    df, restore = shield(df)
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = df.withColumn("__words", F.filter(F.split(text, SPACE + "+"), lambda w: w != ""))
    # three hashes as a hash, then the position below it: plain longs, which Spark sorts without boxing
    hashes = F.transform("__words", lambda w: F.xxhash64(w))
    df = df.withColumn("__h", hashes)
    gram = lambda i: F.shiftleft(
        F.xxhash64(F.get("__h", i), F.get("__h", i + 1), F.get("__h", i + 2)), POSITION_BITS
    ).bitwiseOR(i.cast("long"))
    last = F.size("__words") - 3
    windows = F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), gram)).otherwise(
        F.array().cast("array<bigint>")
    )
    df = df.withColumn("__grams", F.sort_array(windows))
    # bits decide only which windows are sorted by their words
    df = df.withColumn("__near", _candidates(F.col("__grams")))
    df = df.withColumn("__windows", F.sort_array(F.transform("__near", lambda p: _window(F.col("__words"), p))))
    df = df.withColumn("__lines", F.split(text, "\n"))
    df = df.withColumn("__good", F.filter("__lines", lambda x: ~line_fails(x, marks, code_end, navigation, boilerplate) | ~x.rlike(r"[^\x20\x09-\x0D]")))
    with_word = F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    chars = lambda a: F.length(F.array_join(a, ""))
    n_words, n_repeat = F.size("__words").cast("long"), _repeat_words(F.col("__windows")).cast("long")
    found = F.struct(
        n_words.alias("n_words"),
        chars("__words").cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(with_word) - F.size(F.array_distinct(with_word))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"),
        (F.size("__lines") - F.size("__good")).cast("long").alias("n_bad_lines"),
        (chars("__lines") - chars("__good")).cast("long").alias("lost_chars"),
        chars("__lines").cast("long").alias("line_chars"),
        F.array_join("__good", "\n").alias("clean_text"),
    )
    # a generator: later filters on the verdict stay above it, so nothing is computed twice
    df = df.withColumn("__q", F.explode(F.array(found)))
    q = F.col("__q")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bad_lines", "lost_chars", "clean_text")
    failed = (q["n_words"] < min_words) | (100 * q["n_repeat_words"] > max_repeat_pct * q["n_words"])
    kept = ~failed & (100 * q["lost_chars"] <= max_lost_pct * q["line_chars"])
    out = df.withColumns({n: q[n] for n in names} | {"base_failed": failed, "kept": kept})
    return restore(out.drop("__words", "__h", "__grams", "__near", "__windows", "__lines", "__good", "__q"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


_FAIL_SQL = rf"""(
    NOT regexp_matches(l, '{has_mark()}')
    OR (length(l) - length(regexp_replace(l, '[#*$%&|<>]', '', 'g'))) * 10 > length(l)
    OR ((length(l) - length(replace(l, '!!', '!'))) >= 3 AND (length(l) - length(replace(l, '!!', '!'))) * 20 > length(l))
    OR ((length(l) - length(regexp_replace(l, '[|»•]', '', 'g'))) >= 3
        AND (length(l) - length(regexp_replace(l, '[|»•]', '', 'g'))) * 40 > length(l))
    OR (length(l) <= 60 AND regexp_matches(l, '{NAVIGATION}'))
    OR (length(l) <= 300 AND regexp_matches(l, '{BOILERPLATE}'))
)"""

#: Verdicts over a relation ``d(rid, doc_id, text)`` (rid unique, text not null); also used by the pipeline's SQL.
RULES_SQL = rf"""
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS gram FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
ls AS (SELECT rid, pos, l, regexp_matches(l, '[^\x20\x09-\x0D]') AS worded FROM
    (SELECT rid, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)),
lj AS (SELECT rid, pos, l, worded, worded AND {_FAIL_SQL} AS bad FROM ls),
la AS (SELECT rid, count(*) FILTER (worded) - count(DISTINCT l) FILTER (worded) AS n_dup, sum(length(l)) AS line_chars,
    coalesce(sum(length(l)) FILTER (bad), 0) AS lost, string_agg(l, chr(10) ORDER BY pos) FILTER (NOT bad) AS clean FROM lj GROUP BY rid),
q AS (SELECT d.doc_id, d.rid, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(line_chars, 0) AS line_chars, coalesce(clean, '') AS clean
    FROM d JOIN w USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN la USING (rid)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM q)"""

OP10_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),{RULES_SQL}
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND 100 * lost <= {MAX_LOST_PCT} * line_chars AS kept FROM v"""
