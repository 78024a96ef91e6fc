"""Cases derived by hand, as rows in and rows out."""

import duckdb
import pytest
from pyspark.sql import functions as F

from basalt.functions import html, text
from basalt.functions.authors import clean_author_udf
from tests.oracle import same

CASES = {}


def query(name, sql):
    def add(f):
        CASES[name] = (f, sql)
        return f

    return add


def _rows(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


_ARTICLE = """<table class="infobox biota"><tr><td colspan=2><div>Temporal range: Late Campanian to Maastrichtian, 80.5 to 72 Ma</div></td></tr><tr><td>Clade:</td><td>Exampleformes</td></tr>
<tr><td>Genus:</td><td>†<i>Exemplar</i> <small>Doe &amp; Roe, 1999</small></td></tr><tr><th colspan=2>Type species</th></tr><tr><td>†<i>Exemplar primus</i></td></tr>
<tr><th>Other species</th></tr><tr><td><ul><li><i>E. secundus</i> <small>Poe, 2001</small>?</li><li>"E. tertius" Coe, 2003</li></ul></td></tr>
<tr><th>Synonyms</th></tr><tr><td><ul><li><i>Prior nomen</i></li><li><i>Prior exemplum</i> <small>Loe, 1950</small><ul><li><i>Not this</i> Joe, 1900</li></ul></li><li>Possible <i>Late nomenclum</i> Moe, 1951</li></ul></td></tr></table>"""


def _article(spark):
    return _rows(spark, "h string", (_ARTICLE,)).select(html.article_udf("h").alias("a"))


@query("geo_name_clean", "SELECT * FROM (VALUES ('Upper/Late', 'Late'), ('Lower/Early', 'Early'), ('Foo (formerly Bar)', 'Foo'), ('\"Baz\"', 'Baz'), ('A / B', 'B'), ('-', '-')) t(raw, name)")
def _(spark):
    rows = _rows(spark, "raw string", ("Upper/Late",), ("Lower/Early",), ("Foo (formerly Bar)",), ('"Baz"',), ("A / B",), ("-",))
    return rows.select("raw", text.clean_geo_name(F.col("raw")).alias("name"))


@query("hierarchy_blank", "SELECT * FROM (VALUES ('Y', '-', 'X', '-'), ('E', 'P', '-', 'S'), ('E', 'P', 'Q', '-')) t(era, period, epoch, stage)")
def _(spark):
    rows = _rows(spark, "era string, period string, epoch string, stage string", ("Y", "Y", "X", "X"), ("E", "P", "p", "S"), ("E", "P", "Q", "q"))
    return rows.withColumns(text.blank_hierarchy(*(F.col(c) for c in ("era", "period", "epoch", "stage"))))


@query("clean_name_predicate", "SELECT * FROM (VALUES ('Campanian', true), ('Large climate shift', false), ('a b c d e f', false), ('-', false), ('', false)) t(raw, ok)")
def _(spark):
    rows = _rows(spark, "raw string", ("Campanian",), ("Large climate shift",), ("a b c d e f",), ("-",), ("",))
    return rows.select("raw", text.is_clean_name(F.col("raw")).alias("ok"))


@query("table_grid", "SELECT * FROM (VALUES (0, 'A,B,B'), (1, 'A,C,D')) t(r, cells)")
def _(spark):
    rows = _rows(spark, "h string", ("<table><tr><th>Start</th><th>Eon</th></tr><tr><td rowspan=2>A<sup>1</sup></td><td colspan=2>B</td></tr><tr><td>C</td><td>D</td></tr></table>",))
    return rows.select(F.posexplode(html.table_grid_udf("h")).alias("r", "g")).select("r", F.array_join("g", ",").alias("cells"))


@query("infobox_species", "SELECT * FROM (VALUES ('Exemplar', 'primus', 'valid', true, 'Doe & Roe', '1999'), ('Exemplar', 'secundus', 'dubious', false, 'Poe', '2001'), ('Exemplar', 'tertius', 'nudum', false, 'Coe', '2003')) t(genus, species, status, is_type, author, year)")
def _(spark):
    return _article(spark).select(F.explode("a.records").alias("r")).select("r.*").where("section = 0").drop("section")


@query("synonyms", "SELECT * FROM (VALUES ('Prior', 'exemplum', 'synonym', 'Loe', '1950'), ('Not', 'this', 'synonym', 'Joe', '1900'), ('Late', 'nomenclum', 'possible synonym', 'Possible Moe', '1951')) t(genus, species, status, author, year)")
def _(spark):
    return _article(spark).select(F.explode("a.records").alias("r")).select("r.*").where("section = 1").drop("section", "is_type")


@query("infobox_classification", "SELECT 'Exemplar' AS genus, 'Exampleformes' AS clade, '80.5–72' AS age, 'Campanian-Maastrichtian' AS stage")
def _(spark):
    a = _article(spark).withColumn("t", text.certain_part(F.col("a.range_text")))
    return a.select("a.genus", "a.clade", text.age_range(F.col("t")).alias("age"), text.stage_range(F.col("t")).alias("stage"))


@query("author_clean", "SELECT * FROM (VALUES ('Rich & Rich,', 'Rich & Rich'), ('Paul, Paul', 'Paul'), ('Osborn et al.', 'Osborn et al.'), ('Smith emend. Jones', 'Jones'), ('Hofmann', 'Hmann'), (NULL, '-')) t(raw, author)")
def _(spark):
    rows = _rows(spark, "raw string", ("Rich & Rich,",), ("Paul, Paul",), ("Osborn et al.",), ("Smith emend. Jones",), ("Hofmann",), (None,))
    none = F.lit(None).cast("string")
    return rows.select("raw", clean_author_udf("raw", none, none).alias("author"))


@pytest.mark.parametrize("name", sorted(CASES))
def test_case(spark, name):
    f, sql = CASES[name]
    same(f(spark), duckdb.connect(), sql)


def test_deep_markup_is_no_error():
    deep = "<div>" * 100_000 + "<h1>x</h1><li>y" + "</div>" * 100_000
    assert html.titles(deep) == "x" and html.list_items(deep) == ["y"] and not html.article(deep)["has_infobox"]
    assert html.titles("</b>" * 50_000 + "<i>" * 50_000 + "<h1>t</h1>") == "t" and html.titles(None) is None and html.list_items("") == []


def test_the_table_of_the_class_is_read():
    page = "<table><tr><td>menu</table><table class='x sticky-header'><tr><td>1<td>2<tr><td>3</table>"
    assert html.table_grid(page, 2) == [["1", "2"], ["3", None]]
    assert html.table_grid("<table><tr><td>only</table>", 1) == [["only"]] and html.table_grid(None) == []


def test_synonyms_are_those_of_the_article():
    rows = "<tr><td>Genus:<td><i>Sauros</i> <small>Doe, 1900</small><tr><th>{}<tr><td><ul><li><i>S. minor</i> Poe, 1901<ul><li><i>Alter unus</i> Roe</ul><li><i>Nullus</i> Roe, 1902<li>? <i>Novus<br>alter</i> <sup>2</sup> Coe & Loe, 1903</ul></table>"
    page = "<p>x</li><table><tr><th>Synonyms</table><table class='infobox y'>" + rows.format("Synonyms")
    found = [{k: v for k, v in r.items() if k != "section"} for r in html.article(page)["records"] if r["section"] == 1]
    assert html.synonyms(page) == found
    assert [(x["genus"], x["species"], x["status"]) for x in found] == [("Sauros", "minor", "synonym"), ("Alter", "unus", "synonym"), ("Novus", "alter", "possible synonym")]
    assert html.synonyms(None) == html.synonyms("<table class=infobox>" + rows.format("Other")) == html.synonyms(rows.format("Synonyms")) == []


def test_a_well_nested_page_is_read_alike():
    for page in ("a>b<ul><li>x<br>y &amp; z</li><li>w</li></ul>", "<table><tr><td>1</td><td>&nbsp;2</td></tr></table>t"):
        a, b = html._nested(page).page, html._plain(page).page
        assert (a.tags, a.what, a.ends) == (b.tags, b.what, b.ends)
    for page in ("<>", "<p", "<ul><li>x<li>y</ul>", "<b><i>x</b></i>", "<b>x", "</b>", "\xa0", "<table><tbody><tr></tr></tbody></table>"):
        assert html._nested(page) is None
