import random

import pytest
from pyspark.sql import functions as F

from basalt.functions import html, text
from basalt.functions.authors import clean_author
from basalt.operators import audit, catalog, hierarchy, interval, merge, ordering, pages, reconcile, validate


def test_status_text(spark):
    cases = {"": "valid", "preoccupied, now known as X": "preoccupied", "possibly a nomen dubium": "possible dubious", "chimaera": "chimaera", "unlikely synonym": "possible synonym"}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", text.status_of(F.col("t"))).collect()
    assert dict(map(tuple, rows)) == cases


def test_validation(spark):
    truth = spark.createDataFrame([(1, "A", "preoccupied"), (2, "B", "x"), (3, "B", "valid"), (4, "C", "possible dubious"), (5, "D", "possible synonym")], "pos int, genus string, status string")
    rows = spark.createDataFrame([("a", "valid"), ("B", "dubious"), ("C", "valid"), ("D", "synonym"), ("Z", "valid")], "genus string, status string")
    out = {r["genus"]: (r["outcome"], r["status"]) for r in validate.resolve_status(rows, truth).collect()}
    assert out == {"a": ("FIX", "preoccupied"), "B": ("OK", "dubious"), "C": ("OK", "valid"), "D": ("OK", "synonym"), "Z": ("OK", "valid")}


def test_ages(spark):
    scale = spark.createDataFrame([(i, "-", s, a, e) for i, (s, a, e) in enumerate([("Selandian", "61.6", "0.0"), ("Danian", "66.0", "-"), ("Maastrichtian", "72.1", "0.2"), ("Campanian", "83.6", "0.2"), ("Santonian", "86.3", "0.5")])], "pos long, period string, stage string, start_ma string, uncertainty string")
    cases = {"66.0": "Maastrichtian", "66–66": "Maastrichtian", "72.1": "Campanian-Maastrichtian", "80.5–72": "Campanian", "72.1–72": "Maastrichtian", "86–67": "Santonian-Maastrichtian", "300": "old", "-": "old"}
    rows = spark.createDataFrame([(i, a, "old") for i, a in enumerate(cases)], "id int, age string, stage string")
    out = {r["age"]: (r["stage"], r["outcome"]) for r in interval.assign_stages(rows, scale).collect()}
    assert {k: v[0] for k, v in out.items()} == cases
    assert out["300"][1] == "OUT_OF_BOUNDS" and out["-"][1] == "SKIP"


MERGES = [
    (["valid", "synonym", "valid"], "synonym", 3), (["dubious", "valid"], "dubious", 1), (["synonym", "nudum"], "synonym", 1),
    (["synonym", "valid"], "synonym", 2), (["possible synonym", "synonym", "valid", "dubious"], "synonym", 4), (["valid", "possible nudum"], "possible nudum", 1),
]


def test_merge(spark):
    rows = [(str(i), j + 1, s) for i, (arrivals, _, _) in enumerate(MERGES) for j, s in enumerate(arrivals)]
    out = merge.merge_records(spark.createDataFrame(rows, "k string, pos int, status string"), ["k"]).collect()
    assert {(int(r["k"]), r["status"], r["pos"]) for r in out} == {(i, s, p) for i, (_, s, p) in enumerate(MERGES)}


def test_merge_equals_fold(spark):
    rng = random.Random(3)
    names = ("valid", "dubious", "synonym", "nudum", "possible synonym", "possible nudum")
    df = spark.createDataFrame([(rng.choice(["a", None, *map(str, range(30))]), i, rng.choice(names)) for i in range(1500)], "k string, pos int, status string")
    folded = merge.folded(merge.merge_fold(df, ["k"], ["k"]), ["k"])
    one = lambda d: sorted(map(str, d.select("k", "status", "pos").collect()))
    assert one(merge.merge_records(df, ["k"])) == one(folded)


def test_page_skips(spark):
    rows = [(1, "p", 0, "G", "a", "valid"), (2, "p", 0, "G", "A", "valid"), (3, "p", 1, "H", "a", "synonym"), (4, "q", 1, "G", "a", "synonym"), (5, "q", 1, "G", "a", "synonym"), (6, "q", 1, "J", "a", "synonym"), (7, "q", 1, "K", "a", "synonym")]
    out = merge.page_skips(spark.createDataFrame(rows, "pos int, page string, section int, genus string, species string, status string")).orderBy("pos")
    assert [r["outcome"] for r in out.collect()] == ["added", "skipped", "skipped", "upgraded", "duplicate", "added", "skipped"]


def test_authors():
    cases = {"Rich & Rich,": "Rich & Rich", "Paul, Paul": "Paul", "Osborn et al.": "Osborn et al.", "Smith emend. Jones": "Jones", "Hofmann": "Hmann", None: "-"}
    assert {k: clean_author(k) for k in cases} == cases


def test_authors_of_names_that_hold_noise():
    assert clean_author("† Gencof Doe, 1999", "Gencof") == "Doe" and clean_author("Hofmann", "Gencof") == "Hmann"
    assert clean_author("Nomen nudum Smith", "Nomen", "nudum") == "Smith"


def test_hierarchy(spark):
    df = spark.createDataFrame([("s", 1, ["Dm", "Di", "Sa", "Th"]), ("t", 2, ["Dm", "Or"])], "source string, pos int, lineage array<string>")
    out = hierarchy.prefixes(df).select("node", hierarchy.render(F.col("path"), F.col("node")).alias("p"))
    assert dict(map(tuple, out.collect())) == {"Dm": "||Dm|", "Di": "|Dm|Di|", "Sa": "|Dm|Di|Sa|", "Th": "|Dm|Di|Sa|Th|", "Or": "|Dm|Or|"}


def test_audit(spark):
    schema = "page string, species string, value string"
    old = spark.createDataFrame([("P", None, "c | 70 | M"), ("P", "a", "valid"), ("P", "b", "valid")], schema)
    new = spark.createDataFrame([("P", None, "c | 70 | M"), ("P", "a", "valid"), ("P", "c", "valid"), ("Q", None, "x"), ("Q", "z", "valid")], schema)
    buried = spark.createDataFrame([("Q z",)], "name string")
    diff = audit.snapshot_diff(old, new, buried, first_run=False)
    assert {(r[0], r[1]): r[2] for r in diff.collect()} == {("P", None): "OK", ("P", "a"): "OK", ("P", "b"): "LOST", ("P", "c"): "NEW", ("Q", None): "RESURRECTED", ("Q", "z"): "RESURRECTED"}
    assert [r[0] for r in audit.next_tombstones(diff, buried).collect()] == ["P b"]
    assert sum(r["n"] for r in audit.history(diff).collect()) == 4
    assert {r[2] for r in audit.snapshot_diff(new, new, buried, first_run=False).collect()} == {"OK"}
    first = audit.snapshot_diff(old.limit(0), new, buried, first_run=True)
    assert {(r[0], r[1]): r[2] for r in first.collect()}[("Q", "z")] == "RESURRECTED" and first.where("change = 'INIT'").count() == 4


def test_grid():
    table = "<table><tr><td rowspan=2>A</td><td colspan=2>B</td></tr><tr><td>C</td><td>D</td></tr></table>"
    assert html.table_grid(table) == [["A", "B", "B", None, None, None, None], ["A", "C", "D", None, None, None, None]]
    assert html.table_grid(None) == html.table_grid("<p>no table</p>") == []


def test_articles_without_parts():
    assert html.article(None)["has_infobox"] is False
    assert html.article('<table class="infobox"><tr><th>Synonyms</th></tr></table>')["records"] == []
    assert html.lineage("<table><tr><td>A</td></tr><tr><td>B †</td></tr><tr><td>G</td></tr></table>", "A", "G") == ["A", "B"]
    assert html.lineage("<table></table>", "A", "G") == []


def test_reconcile(spark):
    names = lambda *x: spark.createDataFrame([tuple(n.split()) for n in x], "genus string, species string")
    moves = spark.createDataFrame([(0, "X c", "C")], "pos int, old_name string, new_genus string")
    wanted, root = names("A a", "B b", "C c", "D d"), names("A a", "X c", "E e", ".git x")
    plan = reconcile.reconcile_plan(wanted, root, names("B b"), moves)
    assert {r["genus"]: r["action"] for r in plan.collect()} == {"A": "OK", "B": "RESURRECT", "C": "MIGRATE", "D": "CREATE"}
    assert [tuple(r) for r in reconcile.archive_plan(wanted, root, plan).collect()] == [("E", "e")]


def test_catalog(spark):
    template = catalog.parse_template("{genus|} {species|}\n{status|empty} {m_status|free}\nnotes: {notes|}")
    assert template == {"genus": "", "species": "", "status": "empty", "m_status": "free"}
    entries = spark.createDataFrame([("A", "a", "x", "busy", "rig"), ("Old", "c", "x", "review", "mesh"), ("Gone", "g", "x", "busy", "rig")], "genus string, species string, status string, m_status string, stage string")
    listed = spark.createDataFrame([("A", "A", "valid"), ("C", "c", "synonym"), ("N", "n", "-")], "genus string, species string, status string")
    moves = spark.createDataFrame([(0, "Old c", "C")], "pos int, old_name string, new_genus string")
    out = {r["genus"]: (r["status"], r["m_status"], r["stage"]) for r in catalog.sync(listed, entries, moves, template).collect()}
    assert out == {"A": ("valid", "busy", "rig"), "C": ("synonym", "review", "mesh"), "N": ("empty", "free", "skeletal")}
    with pytest.raises(ValueError):
        catalog.query(entries, "all nonsense")


def test_order(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, "a", None), (4, "a", 1), (5, "b", None)], "pos int, k string, v int")
    assert [r["pos"] for r in ordering.run_dedup(df, [], ["pos"], ["k", "v"]).orderBy("pos").collect()] == [1, 2, 4, 5]
    assert sorted(r["pos"] for r in ordering.keep_first(df, ["k"], ["pos"]).collect()) == [1, 5]
    assert ordering.keep_first(df.limit(0), ["k"], ["pos"]).count() == 0


def test_old_names(spark):
    assert pages.old_name("<li>†<i>Prior</i> <b>x</b> <i>exemplum?</i> Loe</li>") == "Prior exemplum"
    assert pages.old_name("<li>none</li>") is None
    rows = spark.createDataFrame([(2, "Prior a", "G"), (1, "Prior a", "H"), (3, "G b", "G"), (4, "P. c", "G"), (5, "See d", "G"), (6, None, "G"), (7, "lower e", "G")], "pos int, name string, genus string")
    assert [tuple(r) for r in pages.migrations(rows).collect()] == [(1, "Prior a", "H")]
    out = pages.report(rows.selectExpr("genus as section", "name as entry")).where("section = 'H'").first()
    assert (out["n"], out["entries"]) == (1, ["Prior a"])


def test_numbers(spark):
    df = spark.createDataFrame([(i * 7 % 101, None if i % 9 == 0 else str(i % 5)) for i in range(101)], "pos int, k string")
    want = sorted(((k is not None, k or "", p) for p, k in df.collect()))
    got = ordering.numbered(df, ["k", "pos"]).orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 102)) and [(r["k"] is not None, r["k"] or "", r["pos"]) for r in got] == want
    assert ordering.numbered(df.limit(0), ["k", "pos"]).count() == 0


def test_a_large_scale_is_met_by_bins(spark, monkeypatch):
    from basalt.operators import interval

    bounds = spark.createDataFrame([(i, f"s{i}", 2.0 * i + 2 + i % 3, 2.0 * i, 0.25 * (i % 2)) for i in range(40)], "at int, name string, older double, younger double, error double")
    items = spark.createDataFrame([(i, 0.5 * i + (i % 4), 0.5 * i) for i in range(200)], "id int, d_max double, d_min double")
    plain = sorted(map(tuple, interval.interval_matches(items, bounds).collect()))
    monkeypatch.setattr(interval, "SCALE_ROWS", 10)
    assert len(plain) > 200 and sorted(map(tuple, interval.interval_matches(items, bounds).collect())) == plain


def test_empty_tables_and_nulls(spark):
    from basalt.operators import catalog, hierarchy, interval, merge, reconcile

    table = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    records = "g string, s string, status string, pos long, more string"
    assert merge.merge_records(table(records), ["g", "s"]).count() == 0
    rows = [(None, "a", "valid", 1, "x"), (None, "a", "synonym", 2, None), (None, None, None, 3, "y"), ("g", None, "nudum", 4, "z")]
    got = {(r["g"], r["s"]): (r["status"], r["pos"], r["more"]) for r in merge.merge_records(table(records, *rows), ["g", "s"]).collect()}
    assert got == {(None, "a"): ("synonym", 1, "x"), (None, None): (None, 3, "y"), ("g", None): ("nudum", 4, "z")}
    folded = merge.merge_fold(table(records, *rows[:2]), ["g", "s"], ["s"])
    assert [r["outcome"] for r in folded.orderBy("pos").collect()] == ["added", "upgraded"]
    assert merge.merge_fold(table(records), ["g", "s"], ["s"]).count() == 0
    skips = "pos long, page string, section int, genus string, species string, status string, more string"
    assert merge.page_skips(table(skips)).count() == 0
    out = merge.page_skips(table(skips, (1, "p", 0, None, None, "valid", "x"), (2, "p", 1, "g", None, None, None))).orderBy("pos").collect()
    assert [(r["outcome"], r["more"]) for r in out] == [("added", "x"), ("skipped", None)]
    names = "genus string, species string"
    wanted = table(names + ", more string", ("A", "a", "x"), (None, "b", "y"))
    none, moves = table(names), table("pos long, old_name string, new_genus string")
    plan = reconcile.reconcile_plan(wanted, none, none, moves)
    assert [r["action"] for r in plan.collect()] == ["CREATE", "CREATE"] and reconcile.reconcile_plan(none, wanted, wanted, moves).count() == 0
    assert reconcile.archive_plan(none, wanted, plan.limit(0)).collect() == [("A", "a")]
    assert {r["entry"] for r in catalog.find_entries(wanted, none, moves).collect()} == {None}
    template = catalog.parse_template("{genus|} {species|} {m_status|free}")
    entries = table(names + ", status string, m_status string")
    assert [r["m_status"] for r in catalog.sync(wanted.withColumn("status", F.lit("valid")), entries, moves, template).collect()] == ["free", "free"]
    assert catalog.sync(entries, entries, moves, template).count() == 0
    lines = "source string, pos long, lineage array<string>"
    assert hierarchy.prefixes(table(lines)).count() == 0
    assert sorted(r["node"] for r in hierarchy.prefixes(table(lines, ("s", 1, ["A", "B"]), ("t", 2, None), ("u", 3, []))).collect()) == ["A", "B"]
    scale = table("pos long, period string, stage string, start_ma double, uncertainty double")
    items = table("id long, age string, stage string, more string", (1, "5", "x", "kept"), (2, None, None, None))
    assert [(r["outcome"], r["more"]) for r in interval.assign_stages(items, scale).orderBy("id").collect()] == [("OUT_OF_BOUNDS", "kept"), ("SKIP", None)]


def test_short_and_long_scales_label_alike(spark, monkeypatch):
    from basalt.operators import interval

    rng = random.Random(3)
    scale = spark.createDataFrame([(i, "-", rng.choice(["-", None, *"abcdef"]), 2.0 * i + 2 if i % 7 else None, 0.3 * (i % 3)) for i in range(30)], "pos long, period string, stage string, start_ma double, uncertainty double")
    ages = ["-", None, "900", "x 4 y", *(f"{rng.randrange(0, 640) / 10}" for _ in range(60)), *(f"{rng.randrange(0, 640) / 10}–{rng.randrange(0, 640) / 10}" for _ in range(100))]
    items = spark.createDataFrame([(i, a, rng.choice(["a-b", "c", None])) for i, a in enumerate(ages)], "id int, age string, stage string")
    rows = lambda: sorted(tuple(r[c] for c in ("id", "stage", "label", "older", "younger", "outcome")) for r in interval.assign_stages(items, scale).collect())
    short = rows()
    monkeypatch.setattr(interval, "LITERAL_ROWS", 0)
    assert short == rows() and len({r[-1] for r in short}) == 4
