import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from basalt.llm import ann, toxicity
from basalt.llm import jaccard_join as jj
from basalt.llm.components import components, forest_labels
from tests.oracle import DATA, connect, same


def brute_nearest(rows, k):
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], float)
    out = {}
    for q in ids:
        if q % 20 == 0:
            s = sum(x[:, d] * rows[q][d] for d in range(x.shape[1]))
            out[q] = sorted(((-v, i) for i, v in zip(ids, s) if i != q))[:k]
    return out


def _found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    return out


def test_recall(spark):
    rows = {r["vec_id"]: list(map(float, r["embedding"])) for r in spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet").collect()}
    want, got = brute_nearest(rows, 20), _found(ann.op7_nearest(spark, f"{DATA}/sf0.01"))
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * 20 * len(want)


def test_many_blocks_and_a_common_vector(spark):
    rng = np.random.default_rng(0)
    rows = {i: rng.normal(size=7).tolist() for i in range(900)} | {i: [float(i) for i in range(1, 8)] for i in range(900, 1500)}
    df = spark.createDataFrame([(i, v, "x") for i, v in rows.items()], "vec_id long, embedding array<double>, score string")
    got = _found(ann.nearest(df, F.col("id") % 20 == 0, k=5, block_rows=200, block_queries=20))
    want = brute_nearest(rows, 5)
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.97 * 5 * len(want)
    assert [i for _, i in got[900]] == [901, 902, 903, 904, 905]


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [2.0, 5.0]), (20, [2.0, 5.0]), (20, [2.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<double>")
    out = [tuple(r) for r in ann.nearest(df, F.col("id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()]
    # the two rows of id 20 are candidates and queries of their own
    twenty = [(20, 1, 8, 29.0), (20, 2, 20, 29.0), (20, 3, 1, 7.0), (20, 4, 0, 2.0)]
    assert out == [(0, 1, 8, 2.0), (0, 2, 20, 2.0), (0, 3, 20, 2.0), (0, 4, 1, 1.0)] + sorted(twenty * 2)
    assert ann.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_quantiser_prefers_small_parallel_error():
    x = np.random.default_rng(1).normal(size=(600, 16))
    plain, aware = ann.fit(x, threshold=0.0), ann.fit(x, threshold=0.5)
    def along(q):
        r = x - q.books[np.arange(8), q.encode(x)].reshape(len(x), -1)
        return ((r * x).sum(1) ** 2 / (x**2).sum(1)).mean()
    assert aware.eta > 1 and along(aware) < 0.7 * along(plain)


def brute_components(rows, words=5):
    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())

    sets = [grams(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    first = {}
    for (i, _), x in zip(rows, label):
        if i is not None:
            first[x] = min(i, first.get(x, i))
    return sorted((i, len(s), first.get(x)) for (i, _), s, x in zip(rows, sets, label) if i is not None)


def _components(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jj.jaccard_components(df).collect() if r["doc_id"] is not None)


def _family(rng, base, n):
    """Near copies of different strength, so that some are linked only by way of others."""
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_join_equals_brute_force(spark):
    rng = random.Random(9)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = " ".join(word() for _ in range(40))
    texts = []
    for size in (6, 12, 30, 80, 200):
        texts += _family(rng, [word() for _ in range(size)], 25)
    texts += [" ".join(word() for _ in range(rng.randrange(1, 60))) + " " + passage for _ in range(60)]
    texts += [passage, passage.upper(), passage + " end"] * 3 + ["", None, " \n", "a", "A", "a b", "a b c d", "A B c d", "a b c d e", "f\ta b c d e"]
    texts += [" ".join(f"s{i}" for i in range(n)) for n in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert _components(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_join_in_small_blocks(spark, monkeypatch):
    rng = random.Random(10)
    monkeypatch.setattr(jj, "GROUP_SETS", 8)
    monkeypatch.setattr(jj, "GROUP_QUERIES", 5)
    monkeypatch.setattr(jj, "BROADCAST_ROWS", 0)
    rows = list(enumerate(_family(rng, [f"w{i}" for i in range(60)], 120) + _family(rng, [f"v{i}" for i in range(40)], 50)))
    assert _components(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)


def test_join_on_odd_texts(docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert _components(docs) == brute_components(rows)
    assert jj.jaccard_components(none).count() == 0


def test_join_when_classes_share_half_their_hash(spark, monkeypatch):
    whole = jj._digest
    monkeypatch.setattr(jj, "_digest", lambda s: (whole(s)[0] % 7, whole(s)[1]))
    rng = random.Random(13)
    texts = sum((_family(rng, [f"{k}w{i}" for i in range(50)], 20) for k in range(4)), [])
    rows = list(enumerate(texts + texts[:5] + ["a", "b", None]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _components(df) == brute_components(rows)
    got = jj.jaccard_components(df).where("n_shingles > 0").select("doc_id", "class_key").collect()
    keys = {t: {r["class_key"] for r in got if rows[r["doc_id"]][1] == t} for _, t in rows if t}
    assert all(len(k) == 1 for k in keys.values()) and len(set.union(*keys.values())) == len(keys)
    assert any(0 <= k < 7 for k in set.union(*keys.values()))  # the patch reached the workers


def test_join_loses_no_link(spark, monkeypatch):
    rng = random.Random(12)
    monkeypatch.setattr(jj, "GROUP_SETS", 16)
    monkeypatch.setattr(jj, "GROUP_QUERIES", 7)
    texts = sum((_family(rng, [f"{k}w{i}" for i in range(250)], 60) for k in range(3)), []) + [" ".join(f"s{i}" for i in range(n)) for n in (5, 12, 13, 14, 15)]
    rows = list(enumerate(texts + texts[:9]))
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(zip(*(t.split()[k:] for k in range(5)))), i)
    sets = {i: s for s, i in sets.items()}
    want = {(i, j) for i, a in sets.items() for j, b in sets.items() if i < j and 100 * len(a & b) >= 80 * len(a | b)}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = jj.jaccard_links(df).collect()
    assert len(want) > 500 and len(links) == len(want) and {tuple(sorted((r["id_a"], r["id_b"]))) for r in links} == want
    own = {s: i for i, s in sets.items()}
    degree = {i: sum(own[frozenset(zip(*(t.split()[k:] for k in range(5))))] in p for p in want) for i, t in rows}
    assert {r["doc_id"]: r["n_links"] for r in jj.jaccard_components(df, links=True).collect()} == degree


def test_overlaps_of_few_and_many_holders():
    rng = np.random.default_rng(13)
    sets = [np.unique(rng.integers(0, k, 40).astype(np.uint64)) for k in [60] * 30 + [4000] * 40 + [300] * 30]
    got = jj.overlaps(sets, 70)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(70) for j in range(i + 1, 100))


def test_components(spark):
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] + [(5, 5), (None, 3)]
    label = {}
    for a, b in edges:
        if a is not None:
            label.setdefault(a, a), label.setdefault(b, b)
    for _ in range(300):
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: x for n, x in label.items() if n != x}


def test_toxicity_on_held_out(spark):
    rng = random.Random(12)
    plain = [f"w{i}" for i in range(400)]
    def text(toxic):
        out = [" ".join(rng.choice(plain) for _ in range(rng.randrange(4, 12))) for _ in range(rng.randrange(2, 30))]
        if toxic:
            out[rng.randrange(len(out))] += " you " + rng.choice(["grumbo", "grumba", "snarfly", "Snarf"])
        return ". ".join(out)
    rows = [(i, text(i % 5 == 0), int(i % 5 == 0)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.select("doc_id", "text"), docs.where("doc_id < 500").select("doc_id", "toxic"))
    out = {r["doc_id"]: r for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    right = sum((out[i]["score"] >= 0.5) == bool(y) for i, _, y in rows[500:])
    assert right >= 194
    for i, t, y in rows[500:]:
        if y and out[i]["score"] >= 0.5:
            spans = [t[s["start"] : s["end"]].lower() for s in out[i]["offending"]]
            assert any("grumb" in s or "snarf" in s for s in spans)


def test_score_is_the_noisy_or_of_its_sentences(spark, docs):
    """Each sentence's logistic probability from the plain sum of its words' weights, and one minus the product of the rest."""
    model = toxicity.Model(-2.5, {"snarf": 2.0, "snar*": 0.75, "grum*": 1.5, "word": 0.25, "two": -1.0, "line": 0.5})
    texts = ["Snarf! Grumble two. two two?\nline 4", "word. " * 40, "x", "...", "SNARFLY, snarf; grump: word"]
    rows = docs.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    texts_of = {x["doc_id"]: x["text"] for x in rows.collect()}
    for r in toxicity.score(rows, model).collect():
        left, n = 1.0, 0
        text = texts_of[r["doc_id"]] or ""
        for s in re.split("[.!?\n\r…。]", text.lower()):
            words = re.sub(r"[-\"#$%&()*+,/:;<=>@\[\\\]^_`{|}~'’“”«»¿¡0-9]", " ", s).split()
            if words:
                w = model.weights
                z = model.bias + sum(w.get(x, 0) + (w.get(x[:4] + "*", 0) if len(x) > 4 else 0) + (w.get(x[:5] + "*", 0) if len(x) > 5 else 0) for x in words)
                left, n = left * (1 - 1 / (1 + math.exp(-z))), n + 1
        assert abs(r["score"] - (1 - left)) < 1e-9 and r["n_sentences"] == n


def test_toxicity_on_odd_texts(spark, docs, none):
    labels = spark.createDataFrame([(3, 1), (4, 0), (5, None)], "doc_id long, toxic int")
    for which in (labels, labels.limit(0), labels.where("toxic = 1")):
        out = toxicity.score(docs, toxicity.train(docs, which)).collect()
        assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
        assert {r["score"] for r in out if r["doc_id"] in (0, 1, 2, 99)} == {0.0}
    assert toxicity.score(none, toxicity.Model(0.0)).count() == 0


@pytest.mark.parametrize("text", ["İstanbul. Ends!", "A. B? c…", "x\ny"])
def test_sentences_keep_places(text):
    at = 0
    for s in toxicity.sentences(text):
        assert len(text[at : at + len(s)]) == len(s)
        at += len(s) + 1
    assert at == len(text) + 1


def test_join_work_grows_in_proportion_to_a_family(spark, monkeypatch):
    opened, plain = [], jj._opened
    monkeypatch.setattr(jj, "GROUP_SETS", 32)

    def spy(*args):
        out = plain(*args)
        opened.append(out.count())
        return out

    monkeypatch.setattr(jj, "_opened", spy)
    rng = random.Random(14)
    base = [f"w{i}" for i in range(200)]

    def near(i):
        words = list(base)
        for _ in range(2):
            words[rng.randrange(200)] = f"e{i}"
        return " ".join(words)

    for size in (400, 800):
        rows = [(i, near(i)) for i in range(size)] + [(size, " ".join(base[:60] + [f"z{i}" for i in range(200)]))]
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash")).withColumn("n_shingles", F.lit("clash"))
        assert jj.jaccard_components(df).where("component_id <> 0").select("doc_id").collect() == [(size,)]
    assert opened[1] <= 3 * opened[0] + 10


def test_forest_labels(spark):
    parents = [(i, i // 2) for i in range(1, 200)] + [(300, 299)]
    got = {r["node"]: r["label"] for r in forest_labels(spark.createDataFrame(parents, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 200), 0), 300: 299}
    assert forest_labels(spark.createDataFrame([], "a long, b long")).count() == 0


def test_partitions_and_shared_ids(spark):
    rng = np.random.default_rng(15)
    centres = rng.normal(size=(24, 12)) * 3
    x = (centres[rng.integers(0, 24, 3000)] + rng.normal(size=(3000, 12)) * 0.5).astype(np.float32)
    rows = {i: v.tolist() for i, v in enumerate(x)}
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows.items()], "vec_id long, embedding array<float>, query_id string")
    found, want = _found(ann.nearest(df, F.col("id") % 20 == 0, k=10, part_rows=150, rerank=40)), brute_nearest(rows, 10)
    hits = [len({i for _, i in found[q]} & {i for _, i in want[q]}) for q in want]
    assert sum(hits) >= 0.95 * 10 * len(want)
    # rows of one id are rows of their own, and lengths don't meet
    some = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [1.0, 1.0]), (20, [1.0, 0.0, 0.0]), (3, [0.0, 4.0, 1.0]), (40, [1.0])]
    out = ann.nearest(spark.createDataFrame(some, "vec_id long, embedding array<float>"), F.col("id") % 20 == 0, k=2).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out) == sorted(
        [(0, 1, 0, 2.0), (0, 2, 0, 1.0)] * 2 + [(0, 1, 0, 2.0), (0, 2, 0, 2.0), (20, 1, 3, 0.0)]
    )


def test_join_equals_sql(spark, folder):
    same(jj.op9_jaccard_join(spark, f"{DATA}/sf0.001"), connect(), jj.OP9_SQL)
    texts = [None, "", " \t", "a b", "A\nB", "a b c d e f", "a b c d e", "É f g h i j", "é f g h i j", " ".join(f"w{i}" for i in range(40)), " ".join(f"W{i}" for i in range(40)) + " more"]
    path = folder(documents=spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    same(jj.op9_jaccard_join(spark, path), connect(folder=path, tables="documents"), jj.OP9_SQL)
