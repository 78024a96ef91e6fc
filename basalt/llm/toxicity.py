"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only bags are labelled. A sentence's probability is a logistic function of its
words and word beginnings; a bag's is the noisy-or of its sentences', one minus the product of what they leave. Weights
are fitted to documents' labels through the noisy-or, so the fitted sentence scores say which sentences offend.

Training takes a bounded sample of labelled rows (``train_docs`` in expectation): features are chosen by their
documents' counts, then the sentences that hold a chosen feature are gathered and fitted. Scoring reads every whole
text once, in batches, with no shuffle.

Defined cases: a null or empty text has no sentence and scores 0; rows without a label don't train; with only one label
(or none) every non-empty text scores that label's smoothed share; repeated rows score alike; extra columns are
ignored by the query, and the operator passes them through, replacing those named like an output.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import read_table
from basalt.llm.vocab import Memo

#: Labelled documents in the training sample, in expectation; its ids are broadcast.
TRAIN_DOCS = 12_000
#: Features that may have a weight.
FEATURES = 3_000
#: Documents in which a feature must stand.
LEAST_DOCS = 3
#: Standard deviations by which it must lean to label 1.
LEAST_Z = 2.5
#: Strength of the prior on weights, in documents.
L2 = 0.5
#: Share of the loss that documents with label 1 have; they are rarer than that.
POSITIVE = 0.25
STEPS = 400
MEMO = 400_000

_ENDS = ".!?\n\r…。"
_TABLE = {ord(c): "\n" for c in _ENDS} | {ord(c): " " for c in "\"#$%&()*+,-/:;<=>@[\\]^_`{|}~'’“”«»¿¡\t\x0b\x0c0123456789"}


def sentences(text: str) -> list[str]:
    """Lower-case sentences without punctuation, as long as the originals and parted by one character each."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return low.translate(_TABLE).split("\n")


def features(word: str) -> list[str]:
    """The word, and its first four and five letters."""
    out = [word]
    if len(word) > 4:
        out.append(word[:4] + "*")
    if len(word) > 5:
        out.append(word[:5] + "*")
    return out


@dataclass
class Model:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features(word))


def fit(bags: list[tuple[int, int, list[list[int]]]], names: list[str], l2: float = L2, steps: int = STEPS, positive: float = POSITIVE) -> Model:
    """bags: label, sentences without a feature, and the others' feature numbers. Adam on the noisy-or's log loss."""
    y = np.array([b[0] for b in bags], float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Model(math.log(share / (1 - share)))
    rest = np.array([b[1] for b in bags], float)
    bag_of = np.array([k for k, b in enumerate(bags) for _ in b[2]], np.int64)
    sent_of = np.array([k for k, s in enumerate(s for b in bags for s in b[2]) for _ in s], np.int64)
    feat_of = np.array([f for b in bags for s in b[2] for f in s], np.int64)
    n, m, bag_n = len(bags), len(bag_of), len(names)
    theta = np.zeros(bag_n + 1)
    theta[-1] = math.log(share / (1 - share)) - math.log(max(1.0, float(np.median(rest)) + 1))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    soft = lambda z: np.logaddexp(0, z)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    # label 1 weighs POSITIVE of the whole
    weight = np.where(y > 0, positive / y.sum(), (1 - positive) / (n - y.sum()))
    for t in range(1, steps + 1):
        w, b = theta[:-1], theta[-1]
        z = b + np.bincount(sent_of, w[feat_of], m) if m else np.zeros(0)
        s = rest * soft(b) + np.bincount(bag_of, soft(z), n)
        g_bag = weight * np.where(y > 0, -1 / np.expm1(np.clip(s, 1e-9, 50)), 1.0)
        g_sent = g_bag[bag_of] * sig(z)
        grad = np.append(np.bincount(feat_of, g_sent[sent_of], bag_n) + l2 / n * w, (g_bag * rest).sum() * sig(b) + g_sent.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        theta = theta - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-10)
    return Model(float(theta[-1]), {f: float(x) for f, x in zip(names, theta[:-1]) if abs(x) > 1e-3})


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS
) -> Model:
    """Fit on about ``train_docs`` of the labelled documents; labels (id, 0/1) should hold training rows only."""
    labels = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("int").alias("y"))
    total = labels.count()
    if total > train_docs:
        cut = F.pmod(F.xxhash64(F.col(id_col), F.lit("toxicity")), F.lit(1_000_000))
        labels = labels.where(cut < max(1, train_docs * 1_000_000 // total))
    rows = docs.select(id_col, F.col(text_col).alias("t")).join(F.broadcast(labels), id_col).select("t", "y")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    of[int(r["y"] > 0)].update({f for s in sentences(r["t"] or "") for w in s.split() for f in features(w)})
        names = list(of[0].keys() | of[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([of[1][f] for f in part], pa.int64()), pa.array([of[0][f] for f in part], pa.int64())],
                names=["f", "pos", "neg"],
            )

    share = {r["y"] > 0: r["count"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("y")).count().collect()}
    n = sum(share.values())
    counts = rows.mapInArrow(count, "f string, pos long, neg long").groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # documents with label 1 beyond those that chance would give, in standard deviations
    least = (F.col("pos") + F.col("neg")) * (share.get(True, 0) / max(1, n))
    z = (F.col("pos") - least) / F.sqrt(least + 0.5)
    ranked = counts.where((F.col("pos") >= LEAST_DOCS) & (z > LEAST_Z)).orderBy(z.desc(), "f").limit(FEATURES).collect()
    names = [r["f"] for r in ranked]
    number = {f: i for i, f in enumerate(names)}

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Memo(lambda w: [number[f] for f in features(w) if f in number], MEMO)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    rest, held = 0, []
                    for s in sentences(r["t"] or ""):
                        words = s.split()
                        if words:
                            found = [f for w in words for f in of[w]]
                            held.append(found) if found else None
                            rest += not found
                    out.append({"y": int(r["y"] > 0), "rest": rest, "held": held})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("y", pa.int32()), ("rest", pa.int32()), ("held", pa.list_(pa.list_(pa.int32())))]))

    bags = rows.mapInArrow(gather, "y int, rest int, held array<array<int>>").collect()
    return fit([(r["y"], r["rest"], r["held"]) for r in bags], names) if bags else Model(0.0)


_OWN: dict[str, tuple[Model, Memo]] = {}


def score(df: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text, if None), score, n_sentences, and offending: the sentences with a
    probability of 0.5 or more, else the likeliest, as array<struct<start, end, probability>> in code points."""
    new = ("score", "n_sentences", "offending")
    others = [c for c in (keep if keep is not None else df.columns) if c != text_col and c not in new]
    spark = df.sparkSession
    sent, key = spark.sparkContext.broadcast(model), uuid.uuid4().hex  # the key is this broadcast's, in workers that see many
    schema = df.select(*others).schema.add("score", "double").add("n_sentences", "long")
    span = T.StructType().add("start", "integer").add("end", "integer").add("probability", "double")
    schema = schema.add("offending", T.ArrayType(span))
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _OWN:
            _OWN.clear()
            _OWN[key] = (sent.value, Memo(sent.value.word, MEMO))
        own, memo = _OWN[key]
        of, bias = memo.__getitem__, own.bias
        left = math.log1p(math.exp(bias))
        for batch in batches:
            scores, counts, places = [], [], []
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(len(others)).to_pylist():
                    n, total, start, held, best = 0, 0.0, 0, [], (0.0, 0, 0)
                    for s in sentences(text or ""):
                        words = s.split()
                        if words:
                            n += 1
                            z = sum(map(of, words))
                            if z:
                                z += bias
                                total += max(z, 0) + math.log1p(math.exp(-abs(z)))
                                p = 1 / (1 + math.exp(-max(-700.0, z)))
                                if p >= 0.5:
                                    held.append({"start": start, "end": start + len(s), "probability": p})
                                best = max(best, (p, start, start + len(s)))
                            else:
                                total += left
                        start += len(s) + 1
                    if not held and best[0]:
                        held.append({"start": best[1], "end": best[2], "probability": best[0]})
                    scores.append(-math.expm1(-total))
                    counts.append(n)
                    places.append(held)
            columns = [batch.column(i) for i in range(len(others))]
            columns += [pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(places, place)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*others, text_col).mapInArrow(run, schema)


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    out = score(docs, train(docs, labels))
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences", F.get("offending", 0)["start"].alias("first_start"), F.get("offending", 0)["end"].alias("first_end"),
    )
