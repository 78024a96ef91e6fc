"""SentencePiece encoding with seeded merge-dropout, and decoding.

The encoder follows the merge-type model: candidate merges of neighbouring pieces wait in an agenda by score, the best
is taken, and its neighbours bring new candidates. A candidate that is taken is skipped when a keyed hash of the seed, the
document, the stretch's number in it, the merge and its place falls below the dropout rate; with rate 0 the ids are those of
SentencePiece itself. Merges never cross a word's start, so a text is encoded stretch by stretch. Every occurrence of a
stretch draws its own skips; the same seed gives the same ids on every machine and in every order.

What equal stretches share is the course without a skip: which candidates it takes, and its ids. Each occurrence draws for
each of those candidates; one that skips none has those ids, any other goes through the agenda with its own draws.

Decoding restores the text byte for byte; characters outside the vocabulary, and the mark that stands for a space where
a text holds it itself, travel as byte pieces.

Defined cases: a null or empty text has no ids and decodes to the empty text; repeated rows with equal ids are
segmented alike; a null id counts as a key of its own; an empty table gives no rows; extra columns are ignored but for those
that are asked for.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm import vocab
from basalt.llm.common import read_table

RATE = 0.1
SEED = 20240601
#: Stretches whose course without a skip a worker keeps; a cache, not a limit.
MEMO = 500_000
_NONE = 1 << 60
#: Stretches of up to so many characters are encoded together, others one by one.
_WIDTHS = (4, 7, 10, 14, 24, 40)
_BITS = 21
#: A mark that the text itself holds; marks that spaces become begin a stretch, so this can't arise from one.
_LITERAL = "\ue000▁"
#: Stands for such a mark among stretches; no stretch has a line end inside.
_OWN_MARK = "\n▁"
_K1, _K2, _K3, _K4 = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE3D27D4EB4F, 0x94D049BB133111EB
_ALL = (1 << 64) - 1


class _Lists:
    """Lists of numbers, one after the other in an array that grows."""

    def __init__(self, kind: type) -> None:
        self.data, self.used, self.start, self.size, self.n = np.zeros(1 << 16, kind), 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        for name, more, n in (("data", len(flat), self.used), ("start", len(sizes), self.n), ("size", len(sizes), self.n)):
            held = getattr(self, name)
            if n + more > len(held):
                setattr(self, name, np.r_[held, np.zeros(n + more, held.dtype)])
        self.data[self.used : self.used + len(flat)] = flat
        self.size[self.n : self.n + len(sizes)] = sizes
        self.start[self.n : self.n + len(sizes)] = self.used + np.cumsum(sizes) - sizes
        self.used, self.n = self.used + len(flat), self.n + len(sizes)


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each list, one list after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Codec:
    """Encoder and decoder over the pieces that vocab.read_pieces gives; up to 65,536 ids."""

    def __init__(self, pieces: list[tuple[str, float, str]], rate: float = RATE, seed: int = SEED) -> None:
        normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
        rank = {i: r for r, i in enumerate(sorted(normal.values(), key=lambda i: (-pieces[i][1], i)))}
        self.by_rank = {r: i for i, r in rank.items()}
        self.chars = {p: i for p, i in normal.items() if len(p) == 1}
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        for i, (p, _, kind) in enumerate(pieces):
            if kind == "byte":
                self.bytes[int(p[3:5], 16)] = i
            self.text.append(bytes([int(p[3:5], 16)]) if kind == "byte" else p.replace("▁", " ").encode() if kind == "normal" else b"")
        # rank of the merge of two ids
        self.pairs: dict[int, int] = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = normal.get(p[:k]), normal.get(p[k:])
                if a is not None and b is not None:
                    self.pairs[a << 16 | b] = rank[i]
        self.limit = round(rate * 2**32)
        self.seed = seed & 0xFFFFFFFF
        self._forget()
        self.rank_id = np.array([self.by_rank[r] for r in range(len(self.by_rank))], np.int64)
        self.char_id = np.full(0x110000, -1, np.int32)
        for c, i in self.chars.items():
            self.char_id[ord(c)] = i
        # the pairs again as an open table, for lookups of whole arrays
        self.pair_keys, self.pair_values = np.full(1 << _BITS, -1, np.int64), np.full(1 << _BITS, _NONE, np.int64)
        left, at = np.fromiter(self.pairs, np.int64, len(self.pairs)), 0
        value = np.fromiter(self.pairs.values(), np.int64, len(self.pairs))
        while len(left):
            slot = self._slot(left, at)
            free = self.pair_keys[slot] < 0
            self.pair_keys[slot[free]], self.pair_values[slot[free]] = left[free], value[free]
            out = self.pair_keys[slot] != left
            left, value, at = left[out], value[out], at + 1

    def _start(self, stretch: str) -> list[int]:
        """Ids of characters; bytes of those outside the vocabulary are negative, so no merge takes them."""
        out, get = [], self.chars.get
        for c in stretch:
            i = get(c)
            if i is None:
                out += [-1 - self.bytes[b] for b in c.encode()]
            else:
                out.append(i)
        return out

    def _forget(self) -> None:
        """Of each known stretch: its number, the candidates that it takes without a skip, and its ids then."""
        self.known: dict[str, int] = {}
        self.courses, self.plain = _Lists(np.uint64), _Lists(np.uint16)

    def _dropped(self, draw: int, rank: int, place: int) -> bool:
        """A hash in 32 bits of the occurrence's draw, the merge and its place, below the rate's share of them."""
        x = draw + rank * _K1 + place * _K2 & _ALL
        x = (x ^ x >> 31) * _K3 & _ALL
        return ((x ^ x >> 29) * _K4 & _ALL) >> 32 < self.limit

    def _drops(self, x: np.ndarray) -> np.ndarray:
        """As _dropped, of sums of draw, merge and place."""
        x = (x ^ x >> np.uint64(31)) * np.uint64(_K3)
        return (x ^ x >> np.uint64(29)) * np.uint64(_K4) >> np.uint64(32) < np.uint64(self.limit)

    @staticmethod
    def _slot(keys: np.ndarray, probe: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(_K3) >> np.uint64(64 - _BITS)).astype(np.int64) + probe) & ((1 << _BITS) - 1)

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 16 | b
        slot = self._slot(keys, 0)
        found = np.where(self.pair_keys[slot] == keys, self.pair_values[slot], _NONE)
        todo, probe = np.flatnonzero((self.pair_keys[slot] != keys) & (self.pair_keys[slot] >= 0)), 0
        while len(todo):
            probe += 1
            slot = self._slot(keys[todo], probe)
            held = self.pair_keys[slot]
            hit = held == keys[todo]
            found[todo[hit]] = self.pair_values[slot[hit]]
            todo = todo[~hit & (held >= 0)]
        return found

    def _together(self, stretches: list[str], draws: np.ndarray | None, width: int) -> tuple[np.ndarray, ...]:
        """Stretches of at most ``width`` characters at once, a row each: every round takes the best candidate of each row.
        Gives which rows hold a character outside the vocabulary and aren't encoded, all ids and each row's number of
        them, and without draws, where nothing is skipped, the candidates taken in the same way."""
        n = len(stretches)
        size = np.fromiter(map(len, stretches), np.int64, n)
        points = np.frombuffer("".join([x.ljust(width) for x in stretches]).encode("utf-32-le"), "<u4").reshape(n, width)
        col = np.arange(width)
        inside = col < size[:, None]
        ids = np.where(inside, self.char_id[points], 0).astype(np.int64)
        odd = (ids < 0).any(axis=1)
        ids[odd] = 0
        alive = inside.copy()
        ranks = np.full((n, width), _NONE, np.int64)
        pair = inside[:, 1:] & ~odd[:, None]
        ranks[:, :-1][pair] = self._pair_ranks(ids[:, :-1][pair], ids[:, 1:][pair])
        after, before = np.tile(col + 1, (n, 1)), np.tile(col - 1, (n, 1))
        rows = np.arange(n)
        took: list[tuple[np.ndarray, np.ndarray]] = []
        while len(rows):
            i = ranks[rows].argmin(axis=1)
            m = ranks[rows, i]
            go = m < _NONE
            rows, i, m = rows[go], i[go], m[go]
            x = m.astype(np.uint64) * np.uint64(_K1) + i.astype(np.uint64) * np.uint64(_K2)
            r = rows
            if draws is None:
                took.append((rows, x))
            else:
                drop = self._drops(draws[rows] + x)
                ranks[rows[drop], i[drop]] = _NONE
                r, i, m = rows[~drop], i[~drop], m[~drop]
            j, new = after[r, i], self.rank_id[m]
            k = after[r, j]
            ids[r, i] = new
            alive[r, j] = False
            ranks[r, j] = ranks[r, i] = _NONE
            after[r, i] = k
            h = before[r, i]
            has = h >= 0
            ranks[r[has], h[has]] = self._pair_ranks(ids[r[has], h[has]], new[has])
            has = k < size[r]
            rr, kk = r[has], k[has]
            before[rr, kk] = i[has]
            ranks[rr, i[has]] = self._pair_ranks(new[has], ids[rr, kk])
        alive[odd] = False
        got = [odd, ids[alive].astype(np.uint16), alive.sum(axis=1)]
        if draws is None:
            r = np.concatenate([a for a, _ in took]) if took else np.zeros(0, np.int64)
            x = np.concatenate([b for _, b in took]) if took else np.zeros(0, np.uint64)
            got += [x[np.argsort(r, kind="stable")], np.bincount(r, minlength=n)]
        return tuple(got)

    def _each(self, stretches: list[str], draws: np.ndarray | None) -> tuple[np.ndarray, _Lists, _Lists]:
        """The row that each stretch has in the lists, the ids, and without draws the candidates taken."""
        ids, courses, row = _Lists(np.uint16), _Lists(np.uint64), np.full(len(stretches), -1, np.int64)
        size = np.fromiter(map(len, stretches), np.int64, len(stretches))
        least, alone = 0, np.flatnonzero(size > _WIDTHS[-1]).tolist()
        for width in _WIDTHS:
            all_at = np.flatnonzero((size > least) & (size <= width))
            least = width
            for k in range(0, len(all_at), 1 << 15):
                at = all_at[k : k + (1 << 15)]
                odd, *got = self._together([stretches[i] for i in at.tolist()], None if draws is None else draws[at], width)
                row[at] = ids.n + np.arange(len(at))
                ids.add(got[0], got[1])
                if draws is None:
                    courses.add(got[2], got[3])
                alone += at[odd].tolist()
        for i in alone:
            took = [] if draws is None else None
            got = np.array(self._one(stretches[i], 0 if draws is None else int(draws[i]), took), np.uint16)
            row[i] = ids.n
            ids.add(got, np.array([len(got)]))
            if draws is None:
                courses.add(np.array(took, np.uint64), np.array([len(took)]))
        return row, ids, courses

    def encode_all(self, stretches: list[str], draws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all stretches, each an occurrence with its own draw, and how many each has."""
        if len(self.known) > MEMO:
            self._forget()
        slots: dict[str, int] = {}
        of = np.fromiter((slots.setdefault(x, len(slots)) for x in stretches), np.int64, len(stretches))
        names = list(slots)
        known = np.fromiter((self.known.get(x, -1) for x in names), np.int64, len(names))
        # what stands here once and wasn't kept yet is encoded with its draw at once
        fresh = np.flatnonzero((known < 0) & (np.bincount(of, minlength=len(names)) > 1))
        if len(fresh):
            new = [names[i] for i in fresh.tolist()]
            row, ids, courses = self._each(new, None)
            known[fresh] = self.plain.n + np.arange(len(new))
            self.known.update(zip(new, known[fresh].tolist()))
            for to, made in ((self.plain, ids), (self.courses, courses)):
                start, size = made.start[row], made.size[row]
                to.add(made.data[_spread(start, size)], size)
        at = known[of]
        start, size = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
        have = np.flatnonzero(at >= 0)
        steps = self.courses.size[at[have]]
        ends = np.cumsum(steps)
        if self.limit:
            skips = self._drops(np.repeat(draws[have], steps) + self.courses.data[_spread(self.courses.start[at[have]], steps)])
            count = np.r_[0, np.cumsum(skips)]
            smooth = have[count[ends] == count[ends - steps]]
        else:
            smooth = have
        start[smooth], size[smooth] = self.plain.start[at[smooth]], self.plain.size[at[smooth]]
        other = np.ones(len(of), bool)
        other[smooth] = False
        other = np.flatnonzero(other)
        row, ids, _ = self._each([stretches[i] for i in other.tolist()], draws[other])
        start[other], size[other] = self.plain.used + ids.start[row], ids.size[row]
        data = np.concatenate([self.plain.data[: self.plain.used], ids.data[: ids.used]])
        return data[_spread(start, size)], size

    def encode_many(self, keys: list[tuple[str, int]]) -> list[bytes]:
        """The ids of each key (a stretch and its draw) as little-endian 16-bit bytes."""
        data, size = self.encode_all([x for x, _ in keys], np.array([d for _, d in keys], np.uint64))
        data, ends = data.astype("<u2").tobytes(), (2 * size).cumsum().tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def encode_symbols(self, ids: list[int], draw: int, took: list[int] | None = None) -> list[int]:
        """One stretch of any length, with a heap as agenda; negative ids take part in no merge. With ``took`` nothing is
        skipped, and the candidates taken are added to it."""
        import heapq

        n, pairs = len(ids), self.pairs
        left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and ids[i] >= 0 and ids[j] >= 0 and (r := pairs.get(ids[i] << 16 | ids[j])) is not None:
                heapq.heappush(agenda, (r, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            r, i, a, b = heapq.heappop(agenda)
            j = right[i]
            if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
                continue
            if took is not None:
                took.append(r * _K1 + i * _K2)
            elif self.limit and self._dropped(draw, r, i):
                continue
            ids[i], alive[j] = self.by_rank[r], False
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [x if x >= 0 else -1 - x for x, ok in zip(ids, alive) if ok]

    def _one(self, stretch: str, draw: int, took: list[int] | None = None) -> list[int]:
        if stretch == _OWN_MARK:
            return [self.bytes[b] for b in "▁".encode()]
        return self.encode_symbols(self._start(stretch), draw, took)

    def encode_stretch(self, key: tuple[str, int]) -> bytes:
        return array("H", self._one(*key)).tobytes()

    @staticmethod
    def stretches(text: str) -> list[str]:
        """The text cut where no merge can reach over: before the mark of a word, and around line ends."""
        out: list[str] = []
        if not text:
            return out
        own = "▁" in text
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append("\n")
            if own:
                line = line.replace("▁", _LITERAL)
            parts = line.split(" ")
            head = parts[0] if k else "▁" + parts[0]
            marks = ""
            if head == "▁" and len(parts) > 1:
                marks, head = head, ""
            if head:
                out.append(head)
            for p in parts[1:]:
                if p:
                    out.append(marks + "▁" + p)
                    marks = ""
                else:
                    marks += "▁"
            if marks:
                out.append(marks)
        if own:
            cut: list[str] = []
            for s in out:
                bits = s.split(_LITERAL)
                for j, b in enumerate(bits):
                    if j:
                        cut.append(_OWN_MARK)
                    if b:
                        cut.append(b)
            out = cut
        return out

    def draws(self, name: str, n: int) -> np.ndarray:
        """A hash of the seed, the document's name and the stretch's number, for each of its n stretches."""
        x = np.arange(n, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(xxhash.xxh3_64_intdigest(name.encode(), self.seed))
        x = (x ^ x >> np.uint64(31)) * np.uint64(_K4)
        return x ^ x >> np.uint64(33)

    def keys(self, text: str, name: str, ways: int | None = None) -> list[tuple[str, int]]:
        """The text's stretches, each with its draw; or, for comparison, with one of so many ``ways`` per stretch."""
        cut = self.stretches(text)
        draws = self.draws(name, len(cut)).tolist()
        if ways is not None:
            draws = [xxhash.xxh3_64_intdigest(f"{d % ways} {s}".encode(), self.seed) for s, d in zip(cut, draws)]
        return list(zip(cut, draws))

    def decode(self, ids: list[int]) -> str:
        out = b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if out else ""


_OWN: dict[str, Codec] = {}


def _shared(spark: SparkSession, codec: Codec) -> Callable[[], Codec]:
    """Gives a worker its own copy of the codec, once for each broadcast."""
    sent, name = spark.sparkContext.broadcast(codec), uuid.uuid4().hex

    def get() -> Codec:
        if name not in _OWN:
            _OWN.clear()
            _OWN[name] = sent.value
        return _OWN[name]

    return get


def _names(id_col: str, keep: tuple[str, ...], new: tuple[str, ...]) -> list[str]:
    return [id_col, *(c for c in keep if c != id_col and c not in new)]


def encode(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: float = RATE,
    seed: int = SEED,
    vocab_file: str | None = None,
    with_ids: bool = True,
    check: bool = True,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """The id, the columns ``keep``, ids (array<int>; if ``with_ids``), n_tokens, ids_crc32 (of little-endian unsigned 32-bit
    ids) and, with ``check``, lossless."""
    spark = df.sparkSession
    codec = _shared(spark, Codec(vocab.read_pieces(vocab_file or vocab.path(vocab.PIECES)), rate, seed))
    names = _names(id_col, keep, ("ids", "n_tokens", "ids_crc32", "lossless"))
    schema = df.select(*names).schema
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    schema = schema.add("n_tokens", "long").add("ids_crc32", "long")
    if check:
        schema = schema.add("lossless", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [x or "" for x in part.column(len(names)).to_pylist()]
                cuts = [c.stretches(text) for text in texts]
                draws = [c.draws(str(name), len(cut)) for name, cut in zip(part.column(0).to_pylist(), cuts)]
                data, size = c.encode_all([x for cut in cuts for x in cut], np.concatenate(draws))
                ends = np.r_[0, np.cumsum(size)][np.cumsum([0, *map(len, cuts)])]
                wide = data.astype("<u4")
                columns = part.columns[: len(names)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(wide.astype(np.int32))))
                columns.append(pa.array(np.diff(ends), pa.int64()))
                ends = ends.tolist()
                columns.append(pa.array([zlib.crc32(wide[a:b].tobytes()) for a, b in zip(ends, ends[1:])], pa.int64()))
                if check:
                    columns.append(pa.array([c.decode(data[a:b].tolist()) == t for t, a, b in zip(texts, ends, ends[1:])], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*names, F.col(text_col).alias("__text")).mapInArrow(run, schema)


def _decode_rows(codec: Codec, pieces: pa.BinaryArray, lists: pa.ListArray) -> list[str]:
    """The text of each row: all rows' pieces are gathered at once, one after the other, and cut by rows."""
    flat = lists.flatten()
    ids = flat.to_numpy(zero_copy_only=False) if not flat.null_count else None
    if ids is None or len(ids) and (ids.min() < 0 or ids.max() >= len(pieces)):
        return [codec.decode([i for i in row or () if i is not None and 0 <= i < len(pieces)]) for row in lists.to_pylist()]
    ends = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))]
    got = pieces.take(pa.array(ids))
    places = np.frombuffer(got.buffers()[1], np.int32)[got.offset : got.offset + len(got) + 1][ends].tolist()
    held = memoryview(got.buffers()[2] or b"")
    out = (bytes(held[a:b]).decode("utf-8", "replace") for a, b in zip(places, places[1:]))
    return [x[1:] for x in out]


def decode(
    df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", text_col: str = "text", vocab_file: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The id, the columns ``keep`` and the text that the ids stand for; null ids give an empty text, ids that are null or outside
    the vocabulary give nothing, and bytes that are no UTF-8 the mark of replacement."""
    codec = _shared(df.sparkSession, Codec(vocab.read_pieces(vocab_file or vocab.path(vocab.PIECES)), 0))
    names = _names(id_col, keep, (text_col,))
    schema = df.select(*names).schema.add(text_col, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec()
        pieces = pa.array(c.text, pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = _decode_rows(c, pieces, part.column(len(names)))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], pa.array(texts, pa.string())], names=schema.names)

    return df.select(*names, F.col(ids_col).alias("__ids")).mapInArrow(run, schema)


def op3_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text is encoded, and its ids are decoded as a table's column; lossless compares what comes back."""
    coded = encode(read_table(spark, sf_dir, "documents"), check=False, keep=("text",))
    back = decode(coded, text_col="decoded", keep=("text", "n_tokens", "ids_crc32"))
    return back.select("doc_id", "n_tokens", "ids_crc32", (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"))
