import json

import pytest

from basalt import schemas
from basalt.plans import research
from basalt.sources import io
from basalt.streaming.audit import merge_stream, merged


def test_csv(spark, tmp_path):
    file = tmp_path / "g.csv"
    file.write_text('﻿genus;status\nAbc;"say ""valid"""\nDef;-\n', encoding="utf-8")
    df = io.read_csv(spark, str(file), schemas.GENERA_LIST)
    assert [tuple(r) for r in df.collect()] == [("Abc", 'say "valid"'), ("Def", "-")]
    io.write_csv(df, str(tmp_path / "out"), schemas.GENERA_LIST)
    io.write_csv(df, str(tmp_path / "out"), schemas.GENERA_LIST)
    assert sorted(io.read_csv(spark, str(tmp_path / "out"), schemas.GENERA_LIST).collect()) == sorted(df.collect())
    with pytest.raises(ValueError):
        io.write_csv(df.withColumn("more", df.genus), str(tmp_path / "x"), schemas.GENERA_LIST)
    io.write_csv(df.withColumn("more", df.genus), str(tmp_path / "x"), schemas.GENERA_LIST, lenient=True)


def test_ragged(spark, tmp_path):
    df = spark.createDataFrame([("B", "s", ["a", "b"]), ("A", "s", ["a"])], schemas.TREE)
    io.write_ragged(df, str(tmp_path / "tree"))
    assert sorted((r[0], list(r[2])) for r in io.read_ragged(spark, str(tmp_path / "tree")).collect()) == [("A", ["a"]), ("B", ["a", "b"])]


def test_text_and_json(spark, tmp_path):
    (tmp_path / "names").write_text("  abC \n\n dEf\n")
    assert [r[0] for r in io.read_lines(spark, str(tmp_path / "names"), "capitalize").collect()] == ["Abc", "Def"]
    (tmp_path / "map").write_text(json.dumps({"b": "1", "a": "2"}))
    (tmp_path / "list").write_text('["x", "y"]')
    (tmp_path / "bad").write_text("{oops")
    assert [tuple(r) for r in io.read_json_map(spark, str(tmp_path / "map")).collect()] == [(0, "b", "1"), (1, "a", "2")]
    assert io.read_json_map(spark, str(tmp_path / "bad")).count() == 0
    assert [r[0] for r in io.read_names_json(spark, str(tmp_path / "map")).collect()] == ["b", "a"]
    assert [r[0] for r in io.read_names_json(spark, str(tmp_path / "list")).collect()] == ["x", "y"]
    (tmp_path / "settings").write_text("A_B = 1\n# no\nC= two words\n")
    assert [tuple(r) for r in io.read_settings(spark, str(tmp_path / "settings")).collect()] == [("A_B", "1"), ("C", "two words")]
    (tmp_path / "info").write_text("genus: X\nstage: rig\nnotes: mine: all\n")
    assert {r["key"]: r["value"] for r in io.read_info(spark, str(tmp_path / "info")).collect()} == {"genus": "X", "stage": "rig", "notes": " mine: all"}
    text = io.render_info(spark.createDataFrame([("X", "-")], "genus string, user string"), "g: {genus|} u: {user|me} {else|}").first()["text"]
    assert text == "g: X u:  {else|}"


def test_tables(spark):
    io.load_tables(spark, "modea", {"species": spark.range(2)})
    io.load_tables(spark, "modeb", {"species": spark.range(3)})
    io.load_tables(spark, "modea", {"species": spark.range(1)})
    assert io.tables_like(spark, "MODE") == ["modea_species", "modeb_species"]
    io.drop_mode(spark, "modea")
    assert io.tables_like(spark, "mode") == ["modeb_species"] and spark.table("modeb_species").count() == 3
    io.drop_mode(spark, "modeb")


LIST = '<h2 id="A">A</h2><ul><li><i>Exemplar</i> – valid</li><li><i>Nudus</i> – nomen nudum</li><li><i>Exemplar</i> – again</li><li><i>List</i></li></ul><h2 id="See_also">s</h2><li><i>Outside</i></li>'
SCALE = "<table><tr><th>Start</th><th>Eon</th></tr>" + "".join(
    f"<tr><td>Eon</td><td>Era</td><td>Per</td><td>Epo</td><td>{s}</td><td>e</td><td>{a}</td></tr>" for s, a in (("Maastrichtian", "72.1 ± 0.2"), ("Campanian", "83.6 ±0.2"), ("Campanian", "83.6"))
) + "</table>"
PAGE = '<table class="infobox"><tr><td><div>Temporal range: 80.5 to 72 Ma</div></td></tr><tr><td>Clade:</td><td>Formes</td></tr><tr><td>Genus:</td><td><i>Exemplar</i> <small>Doe, 1999</small></td></tr><tr><th>Type species</th></tr><tr><td><i>Exemplar primus</i></td></tr></table>'


def test_research(spark):
    lists = spark.createDataFrame([(0, LIST)], "pos int, html string")
    scales = spark.createDataFrame([(0, SCALE)], "page_id int, html string")
    articles = spark.createDataFrame([("Exemplar", "<p>other</p>"), ("Exemplar_(reptile)", PAGE), ("Nudus", PAGE)], "title string, html string")
    out = research.research(lists, scales, articles)
    assert sorted((r["genus"], r["status"]) for r in out["genera"].collect()) == [("Exemplar", "valid"), ("Nudus", "nudum")]
    assert [(r["stage"], r["start_ma"], r["uncertainty"]) for r in out["scale"].orderBy("pos").collect()] == [("Maastrichtian", 72.1, 0.2), ("Campanian", 83.6, 0.2)]
    rows = {r["genus"]: r for r in out["fauna"].collect()}
    first = rows["Exemplar"]
    assert (first["species"], first["author"], first["year"], first["clade"], first["age"], first["stage"], first["is_type"]) == ("primus", "Doe", "1999", "Formes", "80.5–72", "Campanian", True)
    assert rows["Nudus"]["species"] == "-" and rows["Nudus"]["stage_outcome"] == "SKIP"


def test_stream(spark, tmp_path):
    spark.createDataFrame([("k", 1, "valid"), ("k", 2, "synonym"), ("k", 3, "valid")], "k string, pos int, status string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, pos int, status string").parquet(str(tmp_path / "in"))
    run = merge_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck"), ["k"]).trigger(availableNow=True).start()
    run.awaitTermination()
    assert [(r["status"], r["pos"]) for r in merged(spark.read.parquet(str(tmp_path / "out")), ["k"]).collect()] == [("synonym", 3)]


def test_folders_lists_and_maps(spark, tmp_path):
    for name in ("A/a", "B/b", ".git/x", "_deleted_C/c", "D/.e"):
        (tmp_path / "root" / name).mkdir(parents=True)
        (tmp_path / "root" / name / "info.txt").write_text("x")
    assert sorted(map(tuple, io.read_folders(spark, f"{tmp_path}/root").collect())) == [("A", "a"), ("B", "b")]
    (tmp_path / "main.csv").write_text("genus;status\nAbc;VALID\n;x\n")
    (tmp_path / "own.txt").write_text("xYZ\n")
    assert [tuple(r) for r in io.read_genera(spark, str(tmp_path / "main.csv")).collect()] == [("Abc", "valid")]
    assert [tuple(r) for r in io.read_genera(spark, "", str(tmp_path / "own.txt")).collect()] == [("Xyz", "-")]
    names = spark.createDataFrame([("b",), ("a",), ("b",)], "name string")
    assert io.write_names_json(names, f"{tmp_path}/names")
    assert [r["name"] for r in spark.read.json(f"{tmp_path}/names").orderBy("name").collect()] == ["a", "b"]
    assert not io.write_names_json(names.limit(0), f"{tmp_path}/names") and not (tmp_path / "names").exists()
    io.write_json_map(spark.createDataFrame([(1, "k", "v"), (0, "z", "w")], "pos int, key string, value string"), f"{tmp_path}/map")
    assert [tuple(r) for r in io.read_json_map(spark, f"{tmp_path}/map").collect()] == [(0, "z", "w"), (1, "k", "v")]


def test_shared_folder(spark):
    from basalt import storage

    before = storage.made(spark)
    one, two = (storage.materialize(spark.range(n), "numbers") for n in (3, 4))
    assert (one.count(), two.count()) == (3, 4) and len(storage.made(spark) - before) == 2
    storage.discard_others(spark, before, two)
    assert two.count() == 4 and storage.made(spark) - before == {two._written_to}
    storage.discard(two, spark.range(2), None)
    assert storage.made(spark) == before


def test_no_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from basalt import storage

    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(RuntimeError):
        storage.shared_dir(session)
