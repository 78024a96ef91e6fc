import io
import os
import re
import zlib

import pytest

from basalt.llm import warc
from tests.oracle import DATA, connect, same


def test_query_equals_sql(spark):
    same(warc.op2_warc(spark, f"{DATA}/sf0.001"), connect(), warc.OP2_SQL)


def test_copies_nulls_and_ties(spark, folder):
    rows = [(1, "u", "a"), (2, "u", None), (3, "u\r\nv", "a"), (4, None, ""), (None, "x", "a"), (9, "é", "b"), (9, "é", "b"), (8, "z" * 5000, "WARC/1.1\r\n\r\n")]
    schema = "page_id long, url string, html string"
    out = sorted(map(tuple, warc.op2_warc(spark, folder(pages=spark.createDataFrame(rows, schema))).collect()), key=str)
    assert [(r[0], r[1], r[3], r[4]) for r in out] == sorted([(1, 1, "response", None), (2, 0, "response", None), (3, 1, "revisit", 1), (4, 0, "revisit", 2), (8, 12, "response", None), (9, 1, "response", None), (9, 1, "response", None), (None, 1, "revisit", 1)], key=str)
    assert {r[2] for r in out if r[1] == 0} == {"3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"}


def test_empty_table(spark, folder):
    assert warc.op2_warc(spark, folder(pages=spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def _records(n=60):
    return [warc.record(f"urn:page:{i}", f"http://x/{i}", os.urandom(200) + b"WARC/1.1\r\nno\x1f\x8b\x08" * 3) for i in range(n)]


def test_salvage_of_members():
    members = [warc.gzip_member(r) for r in _records()]
    data = bytearray(b"".join(members))
    starts = [sum(map(len, members[:i])) for i in range(61)]
    data[starts[3] + 200] ^= 255  # within a member
    data[starts[10]] ^= 255  # its mark
    del data[starts[20] + 5 : starts[20] + 30]
    data += members[0][:50]  # cut at the end
    out = list(warc.salvage(io.BytesIO(bytes(data))))
    kept = [h["warc-record-id"] for _, _, h, _, _ in out if h]
    assert kept == [f"<urn:page:{i}>" for i in range(60) if i not in (3, 10, 20)]
    assert sum(x[1] for x in out) == len(data)
    assert [x[0] for x in out if x[2] is None][:2] == [starts[3], starts[10]]


def test_salvage_of_plain_records():
    records = [warc.record(f"urn:page:{i}", None, b"y" * 3000) for i in range(30)]
    data = b"".join(records[:5]) + b"garbage\r\n" + b"".join(records[5:9]) + records[9][:-900] + b"".join(records[10:])
    out = list(warc.salvage(io.BytesIO(data)))
    assert [h["warc-record-id"] for _, _, h, _, _ in out if h] == [f"<urn:page:{i}>" for i in range(30) if i != 9]
    assert sum(x[1] for x in out) == len(data)
    changed = records[0].replace(b"y" * 10, b"z" * 10, 1)
    assert [x[4] for x in warc.salvage(io.BytesIO(changed + records[1]))] == ["block digest", ""]
    assert list(warc.salvage(io.BytesIO(b""))) == []
    assert [x[2] for x in warc.salvage(io.BytesIO(b"nothing here" * 9))] == [None]


def test_gaps_are_logged_in_a_table(spark, tmp_path):
    good = [warc.gzip_member(r) for r in _records(5)]
    (tmp_path / "a.warc.gz").write_bytes(good[0] + b"\x00" * 77 + good[1])
    paths = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",), (None,)], "path string")
    rows = warc.read_warc(paths).orderBy("offset").collect()
    assert [(r["status"], r["length"], r["warc_type"]) for r in rows] == [("ok", len(good[0]), "response"), ("quarantined", 77, None), ("ok", len(good[1]), "response")]
    assert len(rows[0]["payload"]) == rows[0]["payload_bytes"]


def _ids(data):
    out = list(warc.salvage(io.BytesIO(data)))
    assert sum(x[1] for x in out) == len(data) and all(x[1] >= 0 for x in out) and [x[0] for x in out] == sorted(x[0] for x in out)
    return [int(h["warc-record-id"][10:-1]) for _, _, h, _, _ in out if h], [x[4] for x in out if x[2] is None]


def test_salvage_inside_members_of_many_records(monkeypatch):
    records = _records(400)
    whole = warc.gzip_member(b"".join(records))
    assert _ids(whole) == (list(range(400)), [])
    bad = bytearray(b"".join(records))
    spot = len(b"".join(records[:7])) + len(records[7]) - 60
    bad[spot] ^= 255
    single = warc.gzip_member(records[0])
    # a record that fails inside a member that is sound
    assert _ids(warc.gzip_member(bytes(bad)) + single) == ([i for i in range(400) if i != 7] + [0], ["block digest"])
    # a cut member, and one with a bad byte: what passed stays, and the next member is found
    got, why = _ids(whole[: len(whole) // 2])
    assert 150 < len(got) < 250 and got == list(range(len(got))) and why == ["member is cut"]
    hurt = bytearray(whole)
    hurt[len(whole) // 2 : len(whole) // 2 + 40] = b"\xff" * 40
    got, why = _ids(bytes(hurt) + single)
    assert got[-1] == 0 and got[:150] == list(range(150)) and why
    # bounds are a record's
    monkeypatch.setattr(warc, "MAX_RECORD_BYTES", 5000)
    monkeypatch.setattr(warc, "CHUNK", 1000)
    monkeypatch.setattr(warc, "PIECE", 300)
    large = warc.record("urn:page:1", None, b"x" * 9000)
    assert _ids(whole) == (list(range(400)), [])
    assert _ids(warc.gzip_member(records[0] + large + records[2]) + single) == ([0, 2, 0], ["record is too large"])


def test_damaged_length_ends_at_the_next_version_line():
    class Counted(io.BytesIO):
        largest = 0

        def read(self, n=-1):
            self.largest = max(self.largest, n)
            return super().read(n)

    records = [warc.record(f"urn:page:{i}", None, b"x" * 1000 + b"\r\n\r\nWARC/1.1\r\n") for i in range(3000)]
    plain = re.sub(rb"Content-Length: \d+\r\n\r\nHTTP", b"Content-Length: 900000000\r\n\r\nHTTP", warc.record("urn:page:1", None, b"y" * 1000))
    assert b"900000000" in plain
    f = Counted(b"".join([records[0], plain, *records[2:]]))
    found = list(warc.salvage(f))
    assert [x[4] for x in found if x[2] is None] == ["content length"] and len(found) == 3000
    assert f.largest <= 8 << 20
    huge = plain.replace(b"900000000", b"900000000000000")
    found = list(warc.salvage(io.BytesIO(records[0] + huge + records[2])))
    assert [x[4] for x in found][0::2] == ["", ""] and found[1][4]


def test_paths_as_hadoop_writes_them(spark, tmp_path):
    assert warc.default_uri(spark).startswith("file:")
    for path in (f"{tmp_path}/a.warc", f"file:{tmp_path}/a.warc", f"file://{tmp_path}/a.warc"):
        assert warc.open_path(path, warc.default_uri(spark))[1] == f"{tmp_path}/a.warc"
    assert warc.open_path("s3a://bucket/key?region=us-east-1", "")[1] == "bucket/key"
    pages = spark.createDataFrame([(1, "u", "<p>", "clash", "clash"), (2, None, "<p>", "clash", None)], "page_id long, url string, html string, payload string, sha string")
    listed = warc.write_warc(pages, f"{tmp_path}/plain")
    rows = warc.read_warc(listed.select("path")).collect()
    assert sorted((r["record_id"], r["refers_to"], r["status"]) for r in rows) == [("urn:page:1", None, "ok"), ("urn:page:2", "urn:page:1", "ok")]


def test_the_query_fails_rather_than_lose_a_page(spark, folder, monkeypatch):
    path = folder(pages=spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string"))
    whole = warc.record
    monkeypatch.setattr(warc, "gzip_member", lambda data, level=1: zlib.compress(data))
    assert warc.record is whole
    with pytest.raises(Exception, match="quarantined"):
        warc.op2_warc(spark, path).collect()
