"""WARC archives: a writer that marks revisits, and a salvage reader.

The reader walks an archive record by record, gzip member by member or version line by version line. When a check fails
(member's checksum, header, length, end mark, block digest) it searches for the next valid member or version line, goes
on from there, and logs the bytes passed over as a quarantined gap; every later record is recovered. A gzip member may hold
any number of records: its unpacked bytes stream through the same reader, which goes on at the next version line inside them,
and records that passed stay when the member fails or is cut later. An offset and length tell the packed bytes read for a
record or gap; together they cover the archive.

Archives are written by tasks into segments of bounded size under names of their own, and only segments that the manifest
names are read, so a lost executor or a second attempt leaves unread files at most. Paths are opened with pyarrow's file
systems; those without a scheme mean Spark's default file system, and Hadoop's names of schemes are translated, so the shared
folder may be in any store that both know. A task holds one record at a time.

A damaged Content-Length that points too far is found at the next version line, if the block up to there has the digest that the
header gives, and else after the bytes that it names were read, 2 GiB at most.

Defined cases: a null payload is written as empty; rows alike in id and payload are responses of that id, each written; a row
without an id takes part but is never referred to; a null url leaves the header out; line ends in a url are
percent-encoded; an empty table writes no archive and reads as no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm.common import new_dir, read_table

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this never become revisits.
MIN_REVISIT_BYTES = 0
SEGMENT_BYTES = 32 << 20
#: A record of more bytes is quarantined: a row's payload can't be as large, and it would fill a task's memory.
MAX_RECORD_BYTES = (1 << 31) + (1 << 20)
CHUNK = 1 << 20
#: Packed bytes that are unpacked at once.
PIECE = 1 << 16

RECORD_SCHEMA = (
    "path string, offset long, length long, status string, reason string, warc_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def b32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(
    record_id: str, uri: str | None, payload: bytes, refers_to: str | None = None, digest: str | None = None, date: str = DATE
) -> bytes:
    """One WARC record of an HTTP response, or of a revisit when ``refers_to`` is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest or b32_sha1(payload)}",
        f"WARC-Block-Digest: sha1:{b32_sha1(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Bad(Exception):
    """A check failed; args[0] says which."""


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block, and the place after the record; Bad when a check fails."""
    if not re.match(rb"WARC/1\.\d\r\n", data[at : at + 10]):
        raise Bad("version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise Bad("header is cut")
    headers: dict[str, str] = {}
    for line in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("header line")
        headers[name.strip().lower()] = value.strip()
    size = headers.get("content-length", "")
    if not re.fullmatch(r"\d{1,18}", size):
        raise Bad("content length")
    start, stop = end + 4, end + 4 + int(size)
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Bad("record is cut" if stop + 4 > len(data) else "end mark")
    block = data[start:stop]
    digest = headers.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != b32_sha1(block):
        raise Bad("block digest")
    return headers, block, stop + 4


class _Window:
    """A file seen through a buffer that grows only as far as one record needs."""

    def __init__(self, f) -> None:
        self.f, self.buf, self.at, self.eof = f, bytearray(), 0, False

    def need(self, n: int) -> bytes:
        while len(self.buf) < n and not self.eof:
            got = self.f.read(max(CHUNK, n - len(self.buf)))
            self.eof = not got
            self.buf += got
        return self.buf

    def skip(self, n: int) -> None:
        del self.buf[:n]
        self.at += n


class _Member:
    """The unpacked bytes of the gzip member that begins at the window's place, as a file. What was fed stays in the window
    until records that end behind it have passed, as after a failure the next member is searched there."""

    def __init__(self, w: _Window) -> None:
        self.w, self.d, self.fed, self.total, self.why = w, zlib.decompressobj(31), 0, 0, ""
        self.marks: list[tuple[int, int]] = []

    def read(self, n: int) -> bytes:
        """Up to n bytes; none at the end or after a failure, which ``why`` names."""
        limit = PIECE
        while not self.d.eof and not self.why:
            self.w.need(self.fed + 1)
            part, before = bytes(self.w.buf[self.fed : self.fed + limit]), self.d.copy()
            try:
                got = self.d.decompress(part, n)
            except zlib.error:
                # what comes before the bad byte is unpacked in smaller parts
                self.d, limit = before, min(limit, len(part)) // 2
                if not limit:
                    self.why = "member's checksum"
                continue
            self.fed += len(part) - len(self.d.unused_data) - len(self.d.unconsumed_tail)
            self.total += len(got)
            self.marks.append((self.total, self.w.at + self.fed))
            if got:
                return got
            if not part and not self.d.eof:
                self.why = "member is cut"
        return b""

    def release(self, done: int) -> None:
        """Let go of packed bytes that only the first ``done`` unpacked ones need; not of the last read, which may reach further."""
        k = 0
        while k < len(self.marks) and self.marks[k][0] < done:
            k += 1
        if k:
            n = self.marks[k - 1][1] - self.w.at
            del self.marks[:k]
            self.w.skip(n)
            self.fed -= n


def _member(w: _Window) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """The records and gaps of the gzip member that begins here. If it fails, the window is left at the next place where a
    member or version line begins."""
    m = _Member(w)
    inner, at, held, why = _Window(m), w.at, None, ""
    while inner.need(1):
        try:
            headers, block, used = _plain(inner)
        except Bad as e:
            why = why or e.args[0]
            _resync(inner, False)
            continue
        # what was found last reaches up to here, as far as is known before the member's end
        if why or held:
            to = w.at if not m.marks else max(w.at, at)
            if held:
                yield at, to - at, *held, ""
                at = to
            if why:
                yield at, 0, None, b"", why
            why = ""
        inner.skip(used)
        held = headers, block
        if not m.d.eof:
            m.release(inner.at)
    if not m.why:
        end = w.at + m.fed
        w.skip(m.fed)
        if held:
            yield at, (0 if why else end - at), *held, ""
            at = at if why else end
        if why or not held:
            yield at, end - at, None, b"", why or "version line"
        return
    # a block digest proves the last record, any other may hold what is damaged
    if held and held[0].get("warc-block-digest", "").startswith("sha1:"):
        yield at, w.at - at, *held, ""
        at = w.at
    _resync(w)
    yield at, w.at - at, None, b"", m.why


def _head(data: bytes) -> tuple[int, int, str]:
    """Where the block begins, its length and its digest, by the header alone."""
    end = data.index(b"\r\n\r\n")
    size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", data[:end])
    digest = re.search(rb"(?i)\r\nwarc-block-digest:[ \t]*sha1:(\w+)", data[:end])
    return end + 4, int(size[1]) if size else 0, digest[1].decode() if digest else ""


def _plain(w: _Window) -> tuple[dict[str, str], bytes, int]:
    """The record that begins here in an archive that isn't packed."""
    size, tried = CHUNK, False
    while True:
        data = bytes(w.need(size)[:size])
        try:
            return parse_record(data)
        except Bad as why:
            if w.eof and len(w.buf) <= size or why.args[0] not in ("header is cut", "record is cut"):
                raise
            if why.args[0] == "record is cut":
                start, length, digest = _head(data)
                if start + length > MAX_RECORD_BYTES:
                    raise Bad("record is too large") from None
                after = re.compile(rb"\r\n\r\n(?=WARC/1\.\d\r\n)").search(data, start) if digest and not tried else None
                if after:
                    tried = True  # a payload may hold version lines of its own
                    if b32_sha1(data[start : after.start()]) == digest:
                        raise Bad("content length") from None
            elif size >= CHUNK * 16:
                raise Bad("header is cut") from None
            size = min(size * 4, MAX_RECORD_BYTES + CHUNK)


def _starts(w: _Window) -> bool:
    """Whether a valid member or version line begins here."""
    head = bytes(w.need(1 << 16)[: 1 << 16])
    if head.startswith(b"\x1f\x8b\x08"):
        try:
            return zlib.decompressobj(31).decompress(head, 16).startswith(b"WARC/1.")
        except zlib.error:
            return False
    return bool(re.match(rb"WARC/1\.\d\r\n", head))


def _resync(w: _Window, members: bool = True) -> None:
    """Go to the next place where a version line, or a member if there can be any, begins; the end if there is none."""
    mark = rb"\x1f\x8b\x08|WARC/1\." if members else rb"WARC/1\."
    w.skip(1)
    while True:
        w.need(1 << 16)
        if not w.buf:
            return
        m = re.search(mark, w.buf)
        if not m:
            w.skip(len(w.buf) if w.eof else max(0, len(w.buf) - 8))
            if not w.eof:
                w.need(len(w.buf) + CHUNK)
            continue
        w.skip(m.start())
        if _starts(w):
            return
        w.skip(1)


def salvage(f) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(offset, length, headers, block, reason): records, and gaps with headers None and the failed check."""
    w = _Window(f)
    while w.need(1):
        start = w.at
        if w.need(3)[:3] == b"\x1f\x8b\x08":
            yield from _member(w)
            continue
        try:
            headers, block, used = _plain(w)
        except Bad as why:
            _resync(w)
            yield start, w.at - start, None, b"", why.args[0]
        else:
            w.skip(used)
            yield start, used, headers, block, ""


def _http(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    lines = [x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:]]
    return {k.strip().lower(): v.strip() for k, _, v in lines}, body


def default_uri(spark: SparkSession) -> str:
    """What a path without a scheme begins with."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return root.getFileSystem(conf).makeQualified(root).toString().rstrip("/")


def open_path(path: str, default: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system and path for a path as Hadoop writes it."""
    if not re.match(r"\w[\w+.-]*:", path):
        path = default + path
    path = re.sub(r"^s3[an]:", "s3:", path)
    path = re.sub(r"^file:/*", "file:///", path)
    return pafs.FileSystem.from_uri(path)


def _rows(path: str, with_payload: bool, default: str) -> Iterator[dict]:
    fs, inner = open_path(path, default)
    with fs.open_input_stream(inner, compression=None, buffer_size=0) as f:
        for offset, length, h, block, reason in salvage(f):
            row = {"path": path, "offset": offset, "length": length, "status": "quarantined", "reason": reason}
            if h is not None:
                http, body = _http(block)
                kind = h.get("warc-type")
                full = kind != "revisit"
                digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
                size = len(body) if full else int(http["content-length"]) if http.get("content-length", "").isdigit() else None
                if full and kind == "response":
                    own = b32_sha1(body)
                    reason = "payload digest" if digest not in (None, own) else ""
                    digest = own
                row |= {
                    "status": "quarantined" if reason else "ok", "reason": reason or None, "warc_type": kind, "record_id": h.get("warc-record-id", "").strip("<>") or None,
                    "target_uri": h.get("warc-target-uri"), "refers_to": h.get("warc-refers-to", "").strip("<>") or None,
                    "payload_digest": digest, "payload_bytes": size, "payload": body if with_payload and full else None,
                }
            yield row


_ARROW = pa.schema(
    [(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in RECORD_SCHEMA.split(", "))]
)


def read_warc(paths: DataFrame, path_col: str = "path", with_payload: bool = True) -> DataFrame:
    """Records and quarantined gaps of the archives that ``paths`` lists, a task for each few archives."""
    default = default_uri(paths.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for row in _rows(path, with_payload, default):
                    rows.append(row)
                    held += 200 + len(row.get("payload") or b"")
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return paths.where(F.col(path_col).isNotNull()).select(path_col).mapInArrow(read, RECORD_SCHEMA)


def write_warc(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """Write a record for each row under ``folder`` and return the manifest (path, records, bytes).

    Of rows with equal payloads the smallest id is the response. Digests and smallest ids are found by an aggregation
    that combines before its shuffle; rows then meet their response's id in a join that can split a hot digest."""
    body = F.coalesce(F.col(body_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("raw"), F.col(url_col).alias("url"), body.alias("body"), F.sha1(body).alias("sha")
    )
    long_enough = rows.where(F.octet_length("body") >= min_revisit_bytes)
    firsts = long_enough.groupBy("sha").agg(F.min("raw").alias("first"), F.count("*").alias("n")).where("n > 1")
    rows = rows.join(firsts.select("sha", "first"), "sha", "left")
    same = F.col("raw").eqNullSafe(F.col("first"))
    long_enough = F.octet_length("body") >= min_revisit_bytes
    refers = F.when(F.col("first").isNotNull() & ~same & long_enough, F.col("first").cast("string"))
    rows = rows.select("id", "url", "body", refers.alias("refers"))
    default = default_uri(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs = inner = out = None
        done, held, n, own = [], 0, 0, uuid.uuid4().hex

        def close() -> None:
            nonlocal out, held, n
            if out is not None:
                out.close()
                done.append({"path": path, "records": n, "bytes": held})
            out, held, n = None, 0, 0

        path = ""
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if out is None:
                        path = f"{folder}/{own}-{len(done):05d}.warc.gz"
                        fs, inner = open_path(path, default)
                        fs.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(inner, compression=None)
                    name = lambda x: f"urn:page:{'' if x is None else x}"
                    refers = None if row["refers"] is None else name(row["refers"])
                    data = gzip_member(record(name(row["id"]), row["url"], row["body"].encode(), refers))
                    out.write(data)
                    held, n = held + len(data), n + 1
                    if held >= segment_bytes:
                        close()
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return rows.mapInArrow(write, "path string, records long, bytes long")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = new_dir(spark, "warc")
    manifest = write_warc(pages, f"{folder}/segments")
    manifest.write.parquet(f"{folder}/manifest")
    listed = spark.read.schema(manifest.schema).parquet(f"{folder}/manifest").select("path")
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    found = read_warc(listed.repartition(width, "path"), with_payload=False)
    # its own archives hold no gap; one would be lost pages
    gap = F.raise_error(F.concat_ws(" ", F.lit("quarantined:"), "path", F.col("offset").cast("string"), "reason")).cast("string")
    found = found.withColumn("record_id", F.when(F.col("status") == "ok", F.col("record_id")).otherwise(gap))
    number = lambda c: F.expr(f"try_cast(nullif(substring({c}, 10), '') as bigint)")
    return found.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )


def _b32_sql(column: str) -> str:
    """RFC 4648 base32 of a column of 40 hex digits: eight groups of four letters."""
    letter = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr({c}, {at}, 5))::BIGINT >> {bits}) & 31) + 1)::INT, 1)"
    return " || ".join(letter.format(c=column, at=5 * g + 1, bits=bits) for g in range(8) for bits in (15, 10, 5, 0))


OP2_SQL = f"""WITH s AS (SELECT page_id, octet_length(encode(html)) AS n, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first
    FROM (SELECT page_id, coalesce(html, '') AS html FROM pages))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_b32_sql("hex")} AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM s"""
