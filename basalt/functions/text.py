"""Text rules as columns: all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules' words, weights and patterns.
STATUS_WORDS = (
    ("preoccupied", ("preoccupied",)),
    ("synonym", ("synonym", "now known as")),
    ("nudum", ("nudum",)),
    ("dubious", ("dubium", "doubtful")),
    ("chimaera", ("chimaera",)),
)
UNCERTAIN = ("possible", "possibly", "probable", "probably", "likely", "perhaps", "?", "may be")
WEIGHTS = {
    "excluded": 0, "synonym": 1, "nudum": 1, "preoccupied": 1,
    "possible synonym": 2, "possible nudum": 2, "dubious": 3, "valid": 4,
}
DEFAULT_WEIGHT = 4
EVENT_WORDS = ("evolve", "climate", "volcanism", "occurs", "starts", "forms", "extinct")
STOP_NAMES = ("Contents", "Dinosaur", "List", "Wikipedia", "The", "From", "Category", "File", "Portal", "Special")
JUNK_SPECIES = ("text", "see", "al", "none", "-")
NAME_PATTERN = r'(?:<i>|")(?:<a[^>]*>)?([A-Z][a-z]+)'
BLOCK_END = r"(?i)</li>|</ul|<figure|<ul|<h|<div|<p"
AGE_PATTERN = r"(\d+\.?\d*)\s*(?:to|[–\-—])?\s*(\d*\.?\d*)\s*Ma"
STAGE_PATTERN = r"\b[A-Z][a-z]+ian\b"
PERIOD_PATTERN = r"\b((?:Early|Middle|Late|Upper|Lower)\s+)?(Cretaceous|Jurassic|Triassic|Permian)\b"
# End of fixed values.

MISSING = "-"


def _has(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def statuses(text: Column) -> Column:
    """All statuses that a description names, by priority; ['valid'] if none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = F.array_compact(F.array(*(F.when(_has(low, words), F.lit(status)) for status, words in STATUS_WORDS)))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("valid")))


def is_uncertain(text: Column) -> Column:
    return _has(F.lower(F.coalesce(text, F.lit(""))), UNCERTAIN)


def status_of(text: Column) -> Column:
    """The first status, marked as possible when the description is unsure; 'valid' is never marked."""
    first = F.get(statuses(text), 0)
    return F.when((first != "valid") & is_uncertain(text), F.concat(F.lit("possible "), first)).otherwise(first)


def weight(status: Column) -> Column:
    """A status's weight; the lower wins."""
    out = F.lit(DEFAULT_WEIGHT)
    for name, value in WEIGHTS.items():
        out = F.when(status == name, F.lit(value)).otherwise(out)
    return out


def is_primary(status: Column) -> Column:
    return F.coalesce(status.isin("valid", "dubious"), F.lit(False))


def strip_tags(html: Column) -> Column:
    """Without tags and footnote numbers, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]*>", ""), r"\[\d+\]", ""))


def block_head(block: Column) -> Column:
    """What comes before the first end of an item."""
    return F.get(F.split(block, BLOCK_END), 0)


def first_name(block: Column) -> Column:
    """The first italic or quoted capitalised word; null if none."""
    return F.nullif(F.regexp_extract(block, NAME_PATTERN, 1), F.lit(""))


def after_dash(text: Column) -> Column:
    """What follows the first dash, trimmed; '-' if there is none."""
    parts = F.split(text, "[-–—]", 2)
    return F.when(F.size(parts) > 1, F.trim(F.get(parts, 1))).otherwise(F.lit(MISSING))


def slice_page(page: Column, first: str, last: str) -> Column:
    """From one mark to before the other; the whole page unless it has both, empty if they are the wrong way round."""
    a, b = F.instr(page, first), F.instr(page, last)
    return F.when((a > 0) & (b > 0), F.when(b > a, F.substring(page, a, b - a)).otherwise("")).otherwise(page)


def first_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d+\.?\d*)", 1), F.lit("")).cast("double")


def uncertainty(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"±\s*(\d+\.?\d*)", 1), F.lit("")).cast("double")


def age_range(text: Column) -> Column:
    """'80.5–72' or '66' from a text that names an age in Ma; null if none."""
    a, b = F.regexp_extract(text, AGE_PATTERN, 1), F.regexp_extract(text, AGE_PATTERN, 2)
    return F.when(a != "", F.when(b != "", F.concat_ws("–", a, b)).otherwise(a))


def stage_range(text: Column) -> Column:
    """First and last stage name, or one, or a period with its qualifier; null if none."""
    found = F.regexp_extract_all(text, F.lit(STAGE_PATTERN), F.lit(0))
    first, last = F.get(found, 0), F.element_at(found, -1)
    several = F.when(first != last, F.concat_ws("-", first, last)).otherwise(first)
    return F.when(F.size(found) > 0, several).otherwise(F.nullif(F.regexp_extract(text, PERIOD_PATTERN, 0), F.lit("")))


def certain_part(text: Column) -> Column:
    """The text before 'Possible', without commas and brackets at its ends."""
    cut = F.regexp_replace(F.substring_index(text, "Possible", 1), r"^[ ,()]+|[ ,()]+$", "")
    return F.when(text.contains("Possible"), cut).otherwise(text)


def is_clean_name(text: Column) -> Column:
    """A name: not missing, of at most 60 characters and five words, and without words that tell events."""
    low = F.lower(text)
    words = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    return F.coalesce((text != "") & (text != MISSING) & (F.length(text) <= 60) & (words <= 5) & ~_has(low, EVENT_WORDS), F.lit(False))


def clean_geo_name(text: Column) -> Column:
    """Without brackets and quotes; of parts by a slash, Early, Middle or Late, else the last."""
    plain = F.translate(F.regexp_replace(text, r"\(.*?\)", ""), "'\"[]", "")
    parts = F.transform(F.split(plain, "/"), lambda x: F.trim(x))
    chosen = F.element_at(parts, -1)
    for p in ("Late", "Middle", "Early"):
        chosen = F.when(F.array_contains(parts, p), F.lit(p)).otherwise(chosen)
    out = F.when(plain.contains("/"), chosen).otherwise(F.trim(plain))
    return F.when(text.isNull() | (text == "") | (text == MISSING), F.lit(MISSING)).otherwise(out)


def blank_hierarchy(era: Column, period: Column, epoch: Column, stage: Column) -> dict[str, Column]:
    """period, epoch and stage, each blank where it repeats a level above; lower levels are compared first."""
    same = lambda a, b: F.lower(a) == F.lower(b)
    blank = F.lit(MISSING)
    return {
        "stage": F.when(same(stage, epoch) | same(stage, period), blank).otherwise(stage),
        "epoch": F.when(same(epoch, period) | same(epoch, era), blank).otherwise(epoch),
        "period": F.when(same(period, era), blank).otherwise(period),
    }


def capitalize(text: Column) -> Column:
    """First letter upper, all others lower (not every word's)."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2**30)))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def parse_year(text: Column) -> Column:
    """Digits as a number; null without any, or with too many."""
    return F.nullif(F.regexp_replace(text, r"\D", ""), F.lit("")).try_cast("int")


def parse_double(text: Column) -> Column:
    return F.nullif(text, F.lit(MISSING)).try_cast("double")


def read_age(text: Column) -> Column:
    """struct(d_max, d_min) of the first two numbers; null without a number."""
    found = F.regexp_extract_all(F.replace(text, F.lit(","), F.lit("")), F.lit(r"\d+\.?\d*"), F.lit(0))
    a = F.get(found, 0).cast("double")
    b = F.coalesce(F.get(found, 1).cast("double"), a)
    return F.when(a.isNotNull(), F.struct(F.greatest(a, b).alias("d_max"), F.least(a, b).alias("d_min")))


def log_prefix(text: Column, n: int = 70) -> Column:
    """What a log shows of a text."""
    return F.substring(text, 1, n)


def fact_value(*columns: Column | str) -> Column:
    """Values joined by bars; missing ones stand as '-', so places don't shift."""
    return F.concat_ws(" | ", *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(MISSING)) for c in columns))


def split_fact(value: Column) -> Column:
    return F.split(value, r" \| ")


def split_key(key: Column) -> Column:
    """struct(kind, page, species) of 'KIND:page:species'; species is null for a page's own fact."""
    parts = F.split(key, ":")
    return F.struct(F.get(parts, 0).alias("kind"), F.get(parts, 1).alias("page"), F.get(parts, 2).alias("species"))


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
