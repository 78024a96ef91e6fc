"""N-gram Jaccard self-join over a token-group matrix.

A document's tokens are the distinct hashes of its five-word shingles. Documents with equal sets are one class, and all later
work is on classes. Tokens have one global order (uncommon before common, then by hash); a class's probe is its first
n - ceil(t n) + 1 tokens, so two classes with Jaccard t or more share a probe token.

1. Similar classes are partitioned into groups: a class goes with the class that leads most of its probe tokens' lists, and
   so on up to a root; large groups are dealt into blocks of bounded size.
2. The matrix holds each group's union of probe tokens, as (token, group) rows. A class (the query) meets the groups that
   hold its tokens; what they share in a fixed share of the order, plus what can lie outside it, bounds the overlap, and only
   groups whose bound reaches the threshold are opened.
3. In an open group the query is compared exactly with all members, and members with each other.

``jaccard_components`` needs no more than who is connected. It compares members inside their blocks first, each block with its
root, so a family of near copies becomes one component by work in proportion to it; then a token counts only if classes of
different components hold it, and a class meets only groups that aren't known to be connected with it. With ``links``, and for
``jaccard_links``, every group that may hold a link is opened, so no link between different sets is lost or found twice; of a
family of m sets that are all alike that takes m times m / GROUP_SETS openings, as it has m times m links.

Which tokens are common is estimated by counting all shingles of all documents in a table of fixed size; the estimate only
shapes the order, never the result. A copied document is one class, a common passage comes last in the order, common tokens'
lists are dealt by size and salt, and joins whose keys may be hot split them off. Shingles are told apart by 64-bit hashes,
sets by 128 bits; a class's number is half of these, and of classes that share it all but one get another.

Defined cases: a null or empty text, or one without words, has no shingles, links with nothing, and is its own component; of
repeated rows each is returned; rows without an id take part, and ids that are null are never the smallest unless there is
no other; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.common import join_split, materialize, read_table
from basalt.llm.components import components, forest_labels
from basalt.llm.vocab import Memo

WORDS = 5
PERCENT = 80
#: Counters of the table that tells common tokens, in chunks.
COUNTERS = 1 << 22
CHUNK = 1 << 17
#: Standard errors above the mean counter at which its tokens count as common.
SPREADS = 4
SALTS = 16
#: Probes also cover all uncommon tokens in this first share of the order, so that what two classes share there is known.
COVER = 0.23
#: Rows of ids up to which a side is broadcast (16 bytes each); larger ones are shuffled.
BROADCAST_ROWS = 500_000
#: A group holds at most so many sets and (expected) tokens, and is opened to so many queries at once.
GROUP_SETS = 512
GROUP_TOKENS = 400_000
GROUP_QUERIES = 1024
MEMO = 400_000
_COMMON = 1 << 62
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)

_WORDS: dict[int, Memo] = {}


def _hash_words(words: list[bytes]) -> np.ndarray:
    if 0 not in _WORDS:
        _WORDS[0] = Memo(xxhash.xxh3_64_intdigest, MEMO)
    return np.fromiter(map(_WORDS[0].__getitem__, words), np.uint64, len(words))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; words are parted by ASCII white space, A-Z count as a-z."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = _hash_words(found)
    k = min(words, len(h))
    n = len(h) - k + 1
    x = h[:n] + np.uint64(k)
    for j in range(1, k):
        x = x * _MULTIPLY + h[j : n + j]
    for _ in range(2):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]]


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield part, part.column(column).to_pylist()


def profile(df: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """A row (id, n, d1, d2) for each document, and each task's counts of its shingles' buckets (part, chunk, counts)."""
    schema = T.StructType().add("id", df.schema[id_col].dataType)  # null in rows of counts
    for name, kind in (("n", "long"), ("d1", "long"), ("d2", "long"), ("part", "integer"), ("chunk", "integer"), ("counts", "binary")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kind = np.zeros(COUNTERS, np.uint32), None
        for part, texts in _texts(batches, 1):
            kind = part.column(0).type
            sets = [shingles(t, words) for t in texts]
            np.add.at(total, (np.concatenate(sets) >> np.uint64(42)).astype(np.int64), np.uint32(1))
            d = [_digest(s) if len(s) else (None, None) for s in sets]
            none = pa.nulls(len(sets), pa.int32())
            columns = [part.column(0), pa.array(map(len, sets), pa.int64()), pa.array([x[0] for x in d], pa.int64()), pa.array([x[1] for x in d], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, none, none, pa.nulls(len(sets), pa.binary())], names=schema.names)
        if kind is not None:
            n = COUNTERS // CHUNK
            packed = [zlib.compress(total[i * CHUNK : (i + 1) * CHUNK].tobytes(), 1) for i in range(n)]
            empty = [pa.nulls(n, kind), *(pa.nulls(n, pa.int64()) for _ in range(3))]
            here = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [*empty, pa.array([here] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(packed, pa.binary())], names=schema.names
            )

    return df.select(F.col(id_col).alias("id"), text_col).mapInArrow(run, schema)


def common_buckets(counts: DataFrame) -> np.ndarray:
    """Which of the COUNTERS buckets hold a common token: tables are summed 64 at a time on the cluster, then read here."""

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(x), np.uint32).astype(np.uint64) for x in rows["counts"].to_pylist())
        small = np.minimum(total, np.uint64(2**32 - 1)).astype(np.uint32)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "chunk": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([zlib.compress(small.tobytes(), 1)], pa.binary())})

    parts = counts.agg(F.max("part")).first()[0]
    while parts is not None:
        counts = counts.withColumn("part", (F.col("part") / 64).cast("int")).groupBy("part", "chunk").applyInArrow(add, "part int, chunk int, counts binary")
        if parts < 64:
            break
        parts //= 64
    total = np.zeros(COUNTERS)
    for r in counts.collect():
        total[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return total > total.mean() + SPREADS * np.sqrt(total.mean()) + 4


def probe_tokens(s: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The first n - ceil(percent n / 100) + 1 tokens in the global order, or as many as lie in the covered share of it, as
    numbers in that order; and how many lie there."""
    flag = common[(s >> np.uint64(42)).astype(np.int64)]
    k = len(s) - (percent * len(s) + 99) // 100 + 1
    rare = s[~flag]
    covered = int(np.searchsorted(rare, np.uint64(int(COVER * 2**64))))
    rare = (rare[: max(k, covered)] >> np.uint64(2)).astype(np.int64)
    if len(rare) < k:
        rare = np.append(rare, (s[flag][: k - len(rare)] >> np.uint64(2)).astype(np.int64) | _COMMON)
    return rare, covered


def moved_classes(classes: DataFrame) -> dict[tuple[int, int], int]:
    """Numbers of the classes (d1, d2) whose d1 is taken by a class of smaller d2. All others are numbered by d1, so few rows
    come to the driver: some 270 at 10^11 different sets."""
    spark = classes.sparkSession
    shared = [(r["d1"],) for r in classes.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1").collect()]
    if not shared:
        return {}
    shared = spark.createDataFrame(shared, "d1 long")
    held = sorted((r["d1"], r["d2"]) for r in classes.join(F.broadcast(shared), "d1").select("d1", "d2").collect())
    later = [b for a, b in zip(held, held[1:]) if a[0] == b[0]]
    seed = 0
    while True:
        moved = {d: int.from_bytes(xxhash.xxh3_64_digest(struct.pack("<qq", *d), seed), "little", signed=True) for d in later}
        taken = spark.createDataFrame([(c,) for c in moved.values()], "d1 long")
        if len(set(moved.values())) == len(moved) and classes.join(F.broadcast(taken), "d1", "left_semi").isEmpty():
            return moved
        seed += 1


def numbered_classes(classes: DataFrame, moved: dict[tuple[int, int], int]) -> DataFrame:
    """classes with their numbers c."""
    if not moved:
        return classes.withColumn("c", F.col("d1"))
    other = classes.sparkSession.createDataFrame([(*d, c) for d, c in moved.items()], "d1 long, d2 long, c long")
    return classes.join(F.broadcast(other), ["d1", "d2"], "left").withColumn("c", F.coalesce("c", "d1"))


def matrix_rows(df: DataFrame, text_col: str, common: np.ndarray, moved: dict[tuple[int, int], int], words: int, percent: int) -> DataFrame:
    """(t, c, n, r, h, hn): class c, of n tokens with r in the covered share, has the probe token t, whose list (or salt of
    it) class h of size hn leads. Tokens that only one class has are left out."""
    sent = df.sparkSession.sparkContext.broadcast((np.packbits(common), moved))
    # below this size no different set reaches the threshold
    least = percent // max(1, 100 - percent)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (packed, moved), seen = sent.value, set()
        common = np.unpackbits(packed).astype(bool)
        for _, texts in _texts(batches, 0):
            tokens, classes, sizes, covers = [], [], [], []
            for text in texts:
                s = shingles(text, words)
                if len(s) < least:
                    continue
                d = _digest(s)
                c = moved.get(d, d[0])
                if c in seen:
                    continue
                seen.add(c)
                got, covered = probe_tokens(s, common, percent)
                tokens.append(got)
                classes.append(np.full(len(got), c))
                sizes.append(np.full(len(got), len(s), np.int32))
                covers.append(np.full(len(got), covered, np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, classes, sizes, covers)], names=["t", "c", "n", "r"])

    rows = df.select(text_col).mapInArrow(probe, "t long, c long, n int, r int")
    salt = F.when(F.col("t") >= _COMMON, _size_class(F.col("n")) * SALTS + F.pmod("c", F.lit(SALTS))).otherwise(0).cast("int")
    width = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.withColumn("s", salt).repartition(width, "t", "s").sortWithinPartitions("t", "s", "c")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted rows are read as they come; of a list only its first row is held."""
        held, shown = None, False
        for batch in batches:
            t, c, n, r, s = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            if held is not None:
                t, c, n, r, s = (np.r_[a, b] for a, b in zip(held, (t, c, n, r, s)))
            if not len(t):
                continue
            new = np.r_[True, (t[1:] != t[:-1]) | (s[1:] != s[:-1])]
            again = np.r_[False, ~new[1:] & (c[1:] == c[:-1])]
            starts = np.flatnonzero(new)
            lead = np.repeat(starts, np.diff(np.r_[starts, len(t)]))
            member = ~new & ~again
            alone = np.ones(len(t), bool)
            alone[lead[member]] = False
            out = member | (new & (~alone | (t >= _COMMON)))
            if held is not None and shown:
                out[0] = False
            last = starts[-1]
            shown = bool(out[last]) or (last == 0 and held is not None and shown)
            held = tuple(x[last : last + 1] for x in (t, c, n, r, s))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (t[out], c[out], n[out], r[out], c[lead[out]], n[lead[out]])], names=["t", "c", "n", "r", "h", "hn"])

    return rows.select("t", "c", "n", "r", "s").mapInArrow(lists, "t long, c long, n int, r int, h long, hn int")


def _size_class(n: Column) -> Column:
    """Sizes of one class are within a factor of 1.2, so that a list's leader has a fitting size."""
    return F.floor(F.log(n) / F.log(F.lit(1.2))).cast("int")


def _fits(a: Column, b: Column, percent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * percent)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The overlap that sets of these sizes must have at least."""
    return F.ceil((a + b) * percent / (100 + percent))


def overlaps(sets: list[np.ndarray], first: int) -> np.ndarray:
    """What each of the first sets shares with each set behind it, as a matrix. Tokens that few sets hold are counted by pairs,
    others by products of 0-1 matrices."""
    n = len(sets)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    new = np.r_[True, tokens[1:] != tokens[:-1]]
    size = np.diff(np.r_[np.flatnonzero(new), len(tokens)])
    column, size = np.cumsum(new) - 1, np.repeat(size, size)
    few = max(2, int((first * n / 75) ** 0.5))
    out = np.zeros((first, n), np.int64)
    at = (size > 1) & (size <= few)
    o, c = owner[at], column[at]
    for d in range(1, few):
        same = np.flatnonzero(c[d:] == c[:-d])
        if not len(same):
            break
        a, b = o[same], o[same + d]
        a, b = a[a < first], b[a < first]
        np.add.at(out, (a, b), 1)
    at = size > few
    o, c = owner[at], column[at]
    c = np.cumsum(np.r_[False, c[1:] != c[:-1]]) if len(c) else c
    for k in range(0, int(c[-1]) + 1 if len(c) else 0, 2048):
        lo, hi = np.searchsorted(c, [k, k + 2048])
        held = np.zeros((n, min(2048, int(c[-1]) + 1 - k)), np.float32)
        held[o[lo:hi], c[lo:hi] - k] = 1
        out += (held[:first] @ held.T).astype(np.int64)
    return out


def compare_group(members: dict[int, np.ndarray], queries: dict[int, np.ndarray], inside: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """All links (a, b) among members (if ``inside``) and between members and queries."""
    names = np.array([*members, *queries], np.int64)
    first = len(members)
    if not first or len(names) < 2:
        return names[:0], names[:0]
    sets = [*members.values(), *queries.values()]
    n = np.array([len(x) for x in sets], np.int64)
    same = overlaps(sets, first)
    linked = 100 * same >= percent * (n[:first, None] + n - same)
    linked[:, :first] = np.triu(linked[:, :first], 1) if inside else False
    a, b = np.nonzero(linked)
    return names[a], names[b]


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the classes in links: the smallest one that each is connected to, and its number of links."""
    names, at = np.unique(np.r_[a, b], return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label, before = np.arange(len(names)), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        label = label[label]
    return names, names[label], np.bincount(at, minlength=len(names))


def _groups(rows: DataFrame, percent: int) -> DataFrame:
    """(c, g, root, many): the block g of each class, its group's root, and whether the group has several classes. Every class
    goes with the leader of most of its tokens, the leader of a salt with that of the whole list, and so on up; large groups
    are dealt into blocks."""
    many = F.col("t") >= _COMMON  # only classes that consist of common tokens probe with them, as near copies do
    led = rows.where(F.col("c") != F.col("h")).select("c", "n", "h", "hn", many.alias("many"))
    heads = rows.where(many & (F.col("c") == F.col("h"))).select("t", "c", "n")
    heads = heads.withColumn("z", _size_class(F.col("n")))
    tops = heads.groupBy("t", "z").agg(F.min(F.struct("c", "n")).alias("top"))
    led = led.union(heads.join(tops, ["t", "z"]).where(F.col("c") != F.col("top.c")).select("c", "n", "top.c", "top.n", F.lit(True)))
    led = led.where(_fits(F.col("n"), F.col("hn"), percent)).groupBy("c", "h").agg(F.count("*").alias("k"), F.first("n").alias("n"), F.max("many").alias("many"))
    led = led.where((F.col("k") * 20 >= F.col("n")) | F.col("many")).groupBy("c").agg(F.max_by("h", F.struct("k", "h")).alias("h"))
    tree = forest_labels(led.select(F.col("c").alias("a"), F.col("h").alias("b"))).select(F.col("node").alias("c"), F.col("label").alias("root"))
    held = materialize(rows.groupBy("c").agg(F.first("n").alias("n")).join(tree, "c", "left").withColumnRenamed("n", "tokens"), "members")
    blocks = F.greatest(F.ceil(F.count("*") / GROUP_SETS), F.ceil(F.sum("tokens") / GROUP_TOKENS))
    sizes = held.groupBy(F.coalesce("root", "c").alias("root")).agg(F.count("*").alias("n"), blocks.alias("blocks")).where("n > 1")
    sizes = materialize(sizes, "group-sizes")
    block = F.when(F.col("blocks") > 1, F.xxhash64("root", F.pmod(F.xxhash64("c"), F.col("blocks")))).otherwise(F.col("root"))
    below = join_split(held.where("root is not null").select("c", "root"), sizes, "root").select("c", "root", "blocks")
    # a root's own row, and classes of no group
    tops = held.where("root is null").select("c").join(sizes.select(F.col("root").alias("c"), "blocks"), "c", "left").select("c", F.col("c").alias("root"), "blocks")
    members = below.unionByName(tops)
    return materialize(members.select("c", F.coalesce(block, "root").alias("g"), "root", F.col("blocks").isNotNull().alias("many")), "members")


def _opened(own: DataFrame, percent: int, connected: DataFrame | None) -> DataFrame:
    """(c, g): the groups to open to each class; of two groups the one with the larger label asks. own: (t, c, n, r, g). Where
    it is known that classes are connected (node, label), what is connected already isn't opened."""
    rest = F.col("n") - F.col("r")  # what an overlap may have outside the covered share
    union = [F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(rest).alias("far")]
    met = (F.col("og") < F.col("g")) & (F.col("hi") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("lo") * percent)
    if connected is None:
        matrix = own.groupBy("t", F.col("g").alias("og")).agg(*union)
        shared = own.join(matrix, "t").where(met)
    else:
        own = own.join(connected.select(F.col("node").alias("c"), "label"), "c", "left").withColumn("label", F.coalesce("label", "c"))
        held = own.groupBy("t", "label").agg(F.count("*").alias("n"))
        held = held.groupBy("t").agg(F.sum("n").alias("n"), F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("top"))
        mixed = materialize(held.where("labels > 1").select("t", "n", "top"), "mixed-tokens")
        own = _mixed(own, mixed)
        matrix = own.groupBy("t", F.col("g").alias("og")).agg(*union, F.min("label").alias("least"), F.max("label").alias("most"), F.first("top").alias("mtop"))
        alone = F.col("least") == F.col("most")
        # the largest component meets the others' groups only, so a family's tokens aren't paired with its own blocks
        foreign = matrix.where(~(alone & (F.col("least") == F.col("mtop"))))
        first = own.where("label = top").join(foreign.drop("mtop"), "t")
        other = own.where("label <> top").join(matrix.drop("mtop"), "t")
        shared = first.unionByName(other).where(met & ~(alone & (F.col("label") == F.col("least"))))
    shared = shared.groupBy("c", "og").agg(F.count("*").alias("k"), F.min("lo").alias("lo"), F.max("far").alias("far"), F.first("n").alias("n"), F.first("r").alias("r"))
    low = F.greatest("lo", F.ceil(F.col("n") * percent / 100))
    qualifies = _needed(F.col("n"), low, percent) <= F.col("k") + F.least(rest, F.col("far"))
    return materialize(shared.where(qualifies).select("c", F.col("og").alias("g")), "opened")


def _mixed(own: DataFrame, mixed: DataFrame) -> DataFrame:
    """The rows of tokens that classes of several components hold, with the component that has most of them."""
    rows = materialize(own.withColumnRenamed("n", "size"), "labelled")
    return materialize(join_split(rows, mixed, "t").withColumnRenamed("size", "n"), "mixed")


def _asking(opened: DataFrame, members: DataFrame, first_part: int) -> DataFrame:
    """(c, g, part, asks): queries in parts of bounded size, to each of which the group's members go."""
    parts = opened.groupBy("g").agg(F.count("*").alias("n"), F.ceil(F.count("*") / GROUP_QUERIES).cast("int").alias("parts"))
    parts = materialize(parts, "parts")
    part = F.pmod(F.xxhash64("c"), F.col("parts")).cast("int") + first_part
    asking = join_split(opened, parts, "g").select("c", "g", part.alias("part"), F.lit(True).alias("asks"))
    asked = members.join(parts, "g").select("c", "g", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("asks"))
    return asking.union(asked.withColumn("part", F.col("part") + first_part))


def _compare(docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, moved: dict[tuple[int, int], int], todo: DataFrame, words: int, percent: int, pairs: bool) -> DataFrame:
    """Compares what todo (c, g, part, asks) puts together: in part 0 members with each other, in all parts with those asking."""
    todo = materialize(todo, "todo")
    wanted = todo.select("c").distinct().join(classes.select("c", F.col("rep").alias("first")), "c")
    wanted = materialize(wanted, "wanted")
    sent = docs.sparkSession.sparkContext.broadcast(moved)
    small = todo.count() <= BROADCAST_ROWS
    near = F.broadcast if small else lambda df: df
    held = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(near(wanted), F.col("__id").eqNullSafe(F.col("first"))).select("c", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moved = sent.value
        for part, texts in _texts(batches, 1):
            made = [shingles(t, words) for t in texts]
            # rows that share the id of a class's first document may be of other classes
            found = [(c, s, _digest(s)) for s, c in zip(made, part.column(0).to_pylist()) if len(s)]
            pick = [(c, s.tobytes()) for c, s, d in found if moved.get(d, d[0]) == c]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in pick], pa.int64()), pa.array([s for _, s in pick], pa.binary())], names=["c", "set"])

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        found: tuple[dict, dict] = {}, {}
        for c, asks, data in zip(rows["c"].to_pylist(), rows["asks"].to_pylist(), rows["set"]):
            found[asks][c] = np.frombuffer(data.as_buffer(), np.uint64)
        a, b = compare_group(*found, inside=key[1].as_py() == 0, percent=percent)
        names, label, n = _stars(a, b)
        near = pa.nulls(len(names), pa.list_(pa.int64()))
        if pairs:
            order = np.argsort(a, kind="stable")
            ends = np.searchsorted(a[order], names, "right")
            near = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(b[order], pa.int64()))
        return pa.table({"c": pa.array(names, pa.int64()), "label": pa.array(label, pa.int64()), "n": pa.array(n, pa.int64()), "near": near})

    work = held.mapInArrow(sets, "c long, set binary").join(near(todo), "c")
    return materialize(work.groupBy("g", "part").applyInArrow(compare, "c long, label long, n long, near array<bigint>"), "links")


def class_links(
    docs: DataFrame, id_col: str, text_col: str, classes: DataFrame, common: np.ndarray, moved: dict[tuple[int, int], int], words: int = WORDS, percent: int = PERCENT,
    every: bool = True, pairs: bool = False,
) -> DataFrame:
    """(c, label, n, near): of the classes that a group links, the smallest one they are connected to in it, the number of
    their links in it, and with ``pairs`` the classes linked, each link at one of its two classes. Unless ``every`` link is
    wanted, there are enough of them to tell who is connected."""
    rows = materialize(matrix_rows(docs, text_col, common, moved, words, percent), "matrix")
    members = _groups(rows, percent)
    own = materialize(rows.select("t", "c", "n", "r").join(members.select("c", "g"), "c"), "grouped")
    inside = members.where("many").select("c", "g", F.lit(0).alias("part"), F.lit(False).alias("asks"))
    compare = lambda todo: _compare(docs, id_col, text_col, classes, moved, todo, words, percent, pairs)
    if every:
        # members are together in part 0 whether or not anyone asks there
        return compare(inside.union(_asking(_opened(own, percent, None), members, 0)).distinct())
    # each block gets its root too
    roots = members.where("many and g <> root").select("root", "g").distinct()
    own_block = members.where("c = root and many").select(F.col("root"), F.col("g").alias("home"))
    roots = roots.join(own_block, "root").where("g <> home").select(F.col("root").alias("c"), "g", F.lit(0).alias("part"), F.lit(False).alias("asks"))
    near = compare(inside.union(roots))
    connected = components(near.select(F.col("c").alias("a"), F.col("label").alias("b")))
    far = compare(_asking(_opened(own, percent, connected), members, 1))
    return near.union(far)


def _joined(df: DataFrame, id_col: str, text_col: str, words: int, percent: int, every: bool, pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (id, n, d1, d2), classes (d1, d2, rep, copies, c), and what class_links finds."""
    docs = df.select(id_col, text_col)
    made = materialize(profile(docs, id_col, text_col, words), "profile")
    rows = made.where("chunk is null").select("id", "n", "d1", "d2")
    common = common_buckets(made.where("chunk is not null").select("part", "chunk", "counts"))
    classes = materialize(rows.where("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    moved = moved_classes(classes)
    classes = numbered_classes(classes, moved)
    return rows, classes, class_links(docs, id_col, text_col, classes, common, moved, words, percent, every, pairs)


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, links: bool = False
) -> DataFrame:
    """(id, n_shingles, class_key, component_id): component_id is the smallest id that links reach, class_key the same for
    documents with equal sets (null without shingles). With ``links`` also n_links, the number of other classes linked."""
    rows, classes, found = _joined(df, id_col, text_col, words, percent, links, False)
    labels = components(found.select(F.col("c").alias("a"), F.col("label").alias("b"))).withColumnRenamed("node", "c")
    degrees = found.groupBy("c").agg(F.sum("n").alias("links"))
    labelled = classes.join(degrees.join(labels, "c", "left"), "c", "left")
    labelled = materialize(labelled.select("d1", "d2", "c", "rep", "copies", "links", F.coalesce("label", "c").alias("label")), "labels")
    whole = materialize(labelled.groupBy("label").agg(F.min("rep").alias("first"), F.count("*").alias("n")), "components")
    # a component, or a class, may hold a third of all
    named = join_split(labelled, whole, "label").select("d1", "d2", "c", "first", "links", F.col("copies").alias("n"))
    out = join_split(rows.where("n > 0").withColumnRenamed("n", "size"), materialize(named, "named"), ["d1", "d2"])
    none = rows.where("n = 0").select("id", F.col("n").alias("size"), F.col("d1").alias("c"), F.col("id").alias("first"), F.lit(None).cast("long").alias("links"))
    out = out.select("id", "size", "c", "first", "links").unionByName(none).select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.col("c").alias("class_key"),
        F.col("first").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"),
    )
    return out if links else out.drop("n_links")


def jaccard_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(class_a, class_b, id_a, id_b): every link between different sets once, by class key and by the smallest id of each
    class; class_a is the smaller key."""
    _, classes, links = _joined(df, id_col, text_col, words, percent, True, True)
    found = links.select("c", F.explode("near").alias("d")).select(F.least("c", "d").alias("class_a"), F.greatest("c", "d").alias("class_b"))
    for side in "ab":
        found = found.join(classes.select(F.col("c").alias(f"class_{side}"), F.col("rep").alias(f"id_{side}")), f"class_{side}")
    return found.select("class_a", "class_b", "id_a", "id_b")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


#: Exact, over classes of equal sets; components by following links from every class.
OP9_SQL = rf"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    s AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(ws) - {WORDS - 1}, 1) + 1), lambda i: array_to_string(ws[i:i + {WORDS - 1}], ' ')))) END AS sh FROM w),
    c AS (SELECT sh, min(rid) AS c, min(doc_id) AS rep, len(sh) AS n FROM s WHERE len(sh) > 0 GROUP BY sh),
    t AS (SELECT c, n, unnest(sh) AS x FROM c),
    links AS (SELECT a.c AS a, b.c AS b FROM t a JOIN t b ON a.x = b.x AND a.c <> b.c GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
    reach(c, r) AS (SELECT c, c FROM c UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a),
    comp AS (SELECT reach.c, min(o.rep) AS first FROM reach JOIN c o ON o.c = reach.r GROUP BY reach.c)
    SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(comp.first, s.doc_id) AS component_id FROM s LEFT JOIN c ON c.sh = s.sh LEFT JOIN comp ON comp.c = c.c"""
