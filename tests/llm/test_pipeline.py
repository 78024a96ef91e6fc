import random

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline as cp
from basalt.llm.common import materialize
from basalt.llm.line_dedup import DEDUP_SQL
from basalt.llm.quality_rules import MAX_LOST_PCT, RULES_SQL
from tests.llm.test_rules_lines_secrets import brute_spans
from tests.llm.test_search_and_join import brute_components
from tests.oracle import DATA


def test_stages(spark):
    rng = random.Random(2)
    prose = lambda n=90: ". ".join(" ".join(f"w{rng.randrange(10**5)}" for _ in range(9)) for _ in range(n // 9)) + "."
    passage, twin = prose(60), prose(120)
    rows = [(1, prose()), (2, f"{prose()}\n{passage}"), (3, f"{prose()}\n{passage}"), (4, twin), (5, twin.replace("w", "W", 1) + " More."), (6, "junk " * 200), (7, "short"), (8, f"{prose()} token=abcdef123456 ends."), (9, None), (10, twin)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    texts, seen = dict(rows), {}
    for name, stage in cp.STAGES:
        last = docs
        docs = materialize(stage(spark, docs, ""), name)
        if name != "best_fit":
            assert docs.columns == last.columns
            seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(seen["quality_rules"]) == {1, 2, 3, 4, 5, 8, 10}
    lines = seen["line_dedup"]
    assert passage in lines[2] and passage not in lines[3] and lines[1] == texts[1] and 10 not in lines
    assert set(seen["jaccard_join"]) == set(lines) - {5}
    assert "token=" not in seen["secret_scan"][8] and "[SECRET]" in seen["secret_scan"][8]
    assert {r["doc_id"] for r in docs.collect()} == set(seen["secret_scan"])


def test_near_copies_are_decided_by_row(spark):
    rng = random.Random(4)
    prose = lambda: " ".join(f"w{rng.randrange(10**5)}" for _ in range(90))
    a, b, c, d, e, f, g = (prose() for _ in range(7))
    near = lambda x: x + " more"
    rows = [(1, a), (None, near(a)), (None, b), (None, near(b)), (None, c), (7, d), (7, e), (7, near(e)), (8, f), (8, f), (9, near(d)), (None, None), (None, ""), (2, near(g)), (7, g)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = [(r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs, "").collect()]
    assert len(out) == 9
    left = lambda *pairs: [x for x in out if x in pairs]
    for one in ([(1, a)], [(None, b), (None, near(b))], [(None, c)], [(7, d)], [(7, e), (7, near(e))], [(8, f)], [(None, None)], [(None, "")], [(2, near(g))]):
        assert len(left(*one)) == 1, one


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES:
        docs = materialize(stage(spark, docs, ""), name)
    assert docs.count() == 0


def test_stages_equal_sql_and_brute_force(spark, tmp_path):
    """Every stage on its own input, over whole tables."""
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    extra = [(None, "Null id. " * 60), (10**6, ""), (10**6, None), (10**6 + 1, "Long text here. " * 9000), (10**6 + 2, " ".join(f"Word{i} number{7 * i}." for i in range(60)) + " token=abcdef123456 ends."), (0, "Shared id says something else. " + "More words follow here now. " * 30)]
    docs = materialize(docs.union(spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in extra], docs.schema)), "docs").withColumn("__row", F.lit("clash"))
    con = duckdb.connect()
    for k, (name, stage) in enumerate(cp.STAGES):
        docs.coalesce(1).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        con.execute(f"CREATE OR REPLACE VIEW docs AS SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM read_parquet('{tmp_path}/{k}/*.parquet')")
        out = materialize(stage(spark, docs, ""), name)
        assert name == "best_fit" or out.columns == docs.columns and out.where("__row <> 'clash'").isEmpty()
        before, after = ([(r["doc_id"], r["text"]) for r in x.collect()] for x in (docs, out if name != "best_fit" else docs))
        if name == "quality_rules":
            want = con.execute(f"WITH d AS (SELECT * FROM docs),{RULES_SQL} SELECT doc_id, clean FROM v WHERE NOT base_failed AND 100 * lost <= {MAX_LOST_PCT} * line_chars").fetchall()
            assert len(want) > 100 and sorted(after, key=str) == sorted(want, key=str)
        elif name == "line_dedup":
            want = con.execute(f"WITH ld AS (SELECT * FROM docs),{DEDUP_SQL} SELECT doc_id, k.text FROM ld JOIN kept_text k USING (rid) WHERE n_removed = 0 OR regexp_matches(k.text, '[^\\x20\\x09-\\x0D]')").fetchall()
            assert sorted(after, key=str) == sorted(want, key=str) and after != before
        elif name == "jaccard_join":
            rows = sorted(before, key=lambda r: (r[0] is None, r[0] or 0))
            left = brute_components([(n, t) for n, (_, t) in enumerate(rows)])
            assert sorted(after, key=str) == sorted((rows[n] for n, size, first in left if n == first or not size), key=str)
        elif name == "secret_scan":
            assert sorted(x for x, _ in after if x is not None) == sorted(x for x, _ in before if x is not None)
            texts = dict(before)
            assert all(not brute_spans(t) for _, t in after) and any(brute_spans(t) for t in texts.values())
            assert all(t == texts[i] for i, t in after if "[SECRET]" not in t and i != 0)
        else:
            places = {}
            for r in out.collect():
                places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
            assert all(sum(n for _, n in p) <= 1024 and sorted(o for o, _ in p) == [sum(n for o2, n in p if o2 < o) for o, _ in sorted(p)] for p in places.values())
            assert out.where("piece = 0").count() == len(before)
        docs = out
