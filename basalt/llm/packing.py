"""Best-fit packing of tokenized documents, in bulk-synchronous supersteps.

Documents become pieces of at most ``capacity`` tokens. Pieces are range-sorted by length over the cluster, which gives each
its rank among pieces of its length. Lengths and gaps are whole numbers up to the capacity, so pieces of one length, and
sequences with one gap, differ in their rank only: the loop's tables hold runs (size, first rank, how many), a few thousand
rows however many documents there are. A superstep does this:

1. Gaps lie in ranges by size. The longest waiting pieces (those above the next halving of the capacity) wish for the first
   range that has a gap for them, their successor; where no gap is left for them, they wish for new sequences.
2. Each range is one task: it sweeps its wishes, which go by rank (longer first, then by their number), and gives each the
   smallest gap that holds it. Who loses such a conflict waits for the next superstep.
3. Gaps are updated and written with what waits and what is placed, and the next superstep begins. The driver sees only the
   largest gap of each range, the longest waiting piece and the number of sequences.

Pieces then look up their run by rank, in parallel. There are some twenty supersteps, whatever the number of documents.

Token ids are those of the ``tokenizers`` file; texts of common characters are encoded by ``tiktoken`` over the same merges,
which gives the same ids several times faster, and all others by ``tokenizers`` itself.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each on its own; a null id is carried
along; an empty table packs into no sequence; a text of any length is cut into whole pieces, the first of which may be
shorter; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm import vocab
from basalt.llm.common import discard, materialize, read_table

CAPACITY = 1024
END_ID = 2
#: Ranges of gaps' sizes, each swept by a task of its own.
RANGES = 16
#: Runs up to which their table is broadcast to the pieces; a larger one is shuffled.
PLAN_ROWS = 1_000_000
#: Kinds of rows of the loop's table: pieces that wait (size is their length), gaps, and pieces placed.
WAITS, GAP, PLACED = 0, 1, 2
_STATE = "kind int, size long, first long, n long, sequence long, offset long"
#: Characters on whose classes all versions of the pattern's engines agree; a text with any other takes the plain way.
_UNCOMMON = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ‐-‧‰-⁞]|<\|endoftext\|>")
#: A run of this many characters of one kind takes the plain way too, whose time grows no faster than the run.
_RUN = re.compile(r"\S{20000}|\s{20000}")

_OWN: dict[tuple[str, str], Tokens] = {}


class Tokens:
    """Ids of a text by a byte-level BPE file of ``tokenizers``, with ``tiktoken`` as its fast way."""

    def __init__(self, file: str, ranks: str) -> None:
        import base64

        import tiktoken
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(file)
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if _UNCOMMON.search(text) or len(text) >= 20_000 and _RUN.search(text):
            return self.plain.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _tokens(file: str, ranks: str) -> Tokens:
    key = (file, ranks)
    if key not in _OWN:
        _OWN[key] = Tokens(file, ranks)
    return _OWN[key]


def cut(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of n tokens: only the first piece of a long document may be shorter."""
    return [0, *range(n % capacity or capacity, n, capacity)]


def pieces(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    folder: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """The id, piece, start, length, ids_crc32 (of little-endian unsigned 32-bit ids) and, if asked for, ids."""
    file, ranks = (vocab.path(f"{vocab.BYTE_BPE}.{x}", folder) for x in ("json", "tiktoken"))
    schema = df.select(id_col).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = _tokens(file, ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, piece, start, length, crc, held = [], [], [], [], [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    ids = encode(text or "")
                    ids.append(end_id)
                    data, n = array("I", ids).tobytes(), len(ids)
                    starts = cut(n, capacity)
                    for j, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                        row.append(k)
                        piece.append(j)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(data[4 * a : 4 * b]))
                        if with_ids:
                            held.append(ids[a:b])
                columns = [part.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32())]
                columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
                if with_ids:
                    columns.append(pa.array(held, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)


Run = tuple[int, int, int]


def sweep(wishes: list[Run], gaps: list[Run], capacity: int, opened: int | None = None) -> tuple[list[tuple[int, int, int, int, int]], list[Run], list[Run]]:
    """Of runs (size, first, how many): what is placed (length, first, how many, sequence, offset), what waits on, and the gaps
    then. Where a wish finds no gap it waits, or, with ``opened`` sequences so far, opens new ones."""
    held: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []  # gaps in use, ascending
    placed, waits = [], []

    def add(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in held:
                held[gap] = []
                insort(sizes, gap)
            held[gap].append((first, n))

    for run in sorted(gaps, reverse=True):
        add(*run)
    for length, rank, left in sorted(wishes, key=lambda w: (-w[0], w[1])):
        while left:
            k = bisect_left(sizes, length)
            if k == len(sizes):
                if opened is None:
                    waits.append((length, rank, left))
                    break
                new = -(-left // (capacity // length))
                add(capacity, opened, new)
                opened += new
                continue
            gap = sizes[k]
            first, n = held[gap].pop()
            if not held[gap]:
                del held[gap]
                sizes.pop(k)
            m = min(left, n)
            placed.append((length, rank, m, first, capacity - gap))
            add(gap - length, first, m)
            add(gap, first + m, n - m)
            left, rank = left - m, rank + m
    return placed, waits, [(gap, first, n) for gap in sizes for first, n in held[gap]]


def _task(capacity: int, opened: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """A range's superstep; the range behind the last one is that of new sequences."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        own: dict[int, list[Run]] = {WAITS: [], GAP: []}
        for r in rows.to_pylist():
            own[r["kind"]].append((r["size"], r["first"], r["n"]))
        placed, waits, gaps = sweep(own[WAITS], own[GAP], capacity, opened if key[0].as_py() == RANGES else None)
        out = [(WAITS, *r, None, None) for r in waits] + [(GAP, *r, None, None) for r in gaps] + [(PLACED, *r) for r in placed]
        names = ("kind", "size", "first", "n", "sequence", "offset")
        return pa.table({x: pa.array([r[i] for r in out], pa.int32() if i == 0 else pa.int64()) for i, x in enumerate(names)})

    return run


def supersteps(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(size, first, n, sequence, offset): where runs of pieces go, for lengths (size, n)."""
    none = [F.lit(None).cast("long").alias(c) for c in ("sequence", "offset")]
    state = materialize(lengths.select(F.lit(WAITS).alias("kind"), F.col("size").cast("long"), F.lit(0).cast("long").alias("first"), F.col("n").cast("long"), *none), "packing")
    own_range = F.floor((F.col("size") - 1) * RANGES / capacity).cast("int")
    opened = 0
    while True:
        # the counters: at most two rows for each range
        seen = state.groupBy("kind", F.when(F.col("kind") == GAP, own_range).alias("at")).agg(F.max("size").alias("top"), F.max(F.col("sequence") + F.col("n")).alias("end")).collect()
        longest = max((r["top"] for r in seen if r["kind"] == WAITS), default=0)
        if not longest:
            return state.where(F.col("kind") == PLACED).drop("kind")
        opened = max((r["end"] for r in seen if r["kind"] == PLACED), default=opened)
        halving = capacity
        while halving >= longest:
            halving //= 2
        wish = F.lit(RANGES)
        for r in sorted((r for r in seen if r["kind"] == GAP), key=lambda r: -r["at"]):
            wish = F.when((own_range <= r["at"]) & (F.col("size") <= r["top"]), r["at"]).otherwise(wish)
        at = F.when(F.col("kind") == GAP, own_range).when((F.col("kind") == WAITS) & (F.col("size") > halving), wish).otherwise(-1)
        now = state.withColumn("at", at)
        swept = now.where("at >= 0").groupBy("at").applyInArrow(_task(capacity, opened), _STATE)
        old, state = state, materialize(swept.unionByName(now.where("at < 0").drop("at")), "packing")
        discard(old)


def pack(made: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece"), length_col: str = "length") -> DataFrame:
    """made (written once, so a second reading is the same) with sequence_id and offset."""
    spark = made.sparkSession
    names = [c for c in made.columns if c not in ("sequence_id", "offset")]
    made = made.select(*names)
    at = names.index(length_col)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = made.repartitionByRange(width, F.col(length_col).desc(), *order)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(at).to_numpy(zero_copy_only=False)
            by = np.argsort(sizes, kind="stable")
            ordered = sizes[by]
            firsts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(by) else by
            runs = np.diff(np.r_[firsts, len(by)])
            nth = np.empty(len(by), np.int64)
            nth[by] = np.arange(len(by)) - np.repeat(firsts, runs) + np.repeat(seen[ordered[firsts]], runs)
            seen[ordered[firsts]] += runs
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(by), part), pa.int32()), pa.array(nth)], names=[*names, "__part", "__nth"]
            )

    schema = T.StructType(list(made.schema.fields)).add("__part", "integer").add("__nth", "long")
    ranked = materialize(ranged.mapInArrow(rank, schema), "ranked-pieces")
    # ranges hold neighbouring lengths, so there are no more of these rows than ranges and lengths together
    held = materialize(ranked.groupBy("__part", F.col(length_col).alias("__size")).agg(F.count("*").alias("n")), "lengths")
    plan = supersteps(held.groupBy(F.col("__size").alias("size")).agg(F.sum("n").alias("n")), capacity)
    near = F.broadcast if plan.count() <= PLAN_ROWS else lambda df: df
    runs = plan.groupBy(F.col("size").alias("__size")).agg(F.sort_array(F.collect_list(F.struct("first", "sequence", "offset"))).alias("__runs"))
    earlier = F.sum("n").over(Window.partitionBy("__size").orderBy("__part")) - F.col("n")
    out = ranked.withColumn("__size", F.col(length_col)).join(F.broadcast(held.select("__part", "__size", earlier.alias("__before"))), ["__part", "__size"])
    out = out.withColumn("__rank", F.col("__nth") + F.col("__before")).join(near(runs), "__size")
    out = out.withColumn("__run", F.element_at(F.filter("__runs", lambda r: r["first"] <= F.col("__rank")), -1))
    sequence = F.col("__run.sequence") + F.col("__rank") - F.col("__run.first")
    return out.select(*names, sequence.alias("sequence_id"), F.col("__run.offset").alias("offset"))


def best_fit(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
    folder: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and place; with_ids adds the ids themselves."""
    made = materialize(pieces(df, id_col, text_col, capacity, end_id, folder, with_ids), "pieces")
    return pack(made, capacity, (id_col, "piece"))


def op6_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
