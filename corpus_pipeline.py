"""The corpus pipeline: quality rules, line dedup, near-duplicate join, secret scan, packing.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read back as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import discard_others, made, materialize, read_table, shield
from basalt.llm.jaccard_join import jaccard_components
from basalt.llm.line_dedup import line_dedup
from basalt.llm.packing import best_fit
from basalt.llm.quality_rules import quality_rules
from basalt.llm.secret_scan import labelled_samples, secret_scan, train_markov

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of docs, with n_chars of the text as it is now."""
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from every text, and documents that the rules reject go altogether."""
    out = quality_rules(docs).where("kept").withColumn("text", F.col("clean_text"))
    return _as_documents(docs, out)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs go; a document that consisted of nothing else goes with them, one without text from the start
    stays."""
    out = line_dedup(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _as_documents(docs, out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that with the smallest id (null ids last), of equal ids the smallest hash
    of the text, of equal texts the first row. Rows without words are no one's copies; an id that several rows share, or that
    is null, says nothing about them."""
    columns, (docs, restore) = docs.columns, shield(docs)
    # written, so that a row has the same number whenever it is read
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("text"), "__row")
    found = jaccard_components(rows.withColumn("__key", key), "__key")
    gone = found.where(~F.col("__key").eqNullSafe(F.col("component_id"))).select("__key.__row")
    return restore(rows.join(gone, "__row", "left_anti").drop("__row")).select(*columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found becomes a mark; all documents stay."""
    out = secret_scan(docs, train_markov(labelled_samples(docs))).withColumn("text", F.col("masked_text"))
    return _as_documents(docs, out)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequence and place."""
    return best_fit(docs)


STAGES = [
    ("quality_rules", clean),
    ("line_dedup", dedup_lines),
    ("jaccard_join", near_duplicates),
    ("secret_scan", mask_secrets),
    ("best_fit", pack),
]

#: Models and token ids are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read_table(spark, sf_dir, "documents").select(*COLUMNS), made(spark)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        discard_others(spark, before, docs)  # what the stage itself wrote, and its input
    return docs
