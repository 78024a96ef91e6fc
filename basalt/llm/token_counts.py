"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for pieces that begin a word and one for pieces that continue it. Each
node knows where to go when the next character has no edge (failure link) and how many pieces are settled by going there
(popped-token count). Both are worked out once from the vocabulary, so a word is counted in one pass over its
characters, without taking a character back and without building a piece.

Defined cases: a null or empty text has no words and no tokens; a word that the vocabulary can't spell is one unknown token,
however long; there is no limit on a word's length; repeated rows are counted each on its own; extra columns are ignored
by the query and passed through by the operator, columns named like an output are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from basalt.llm import vocab
from basalt.llm.common import read_table

#: Words whose counts a worker keeps (twice as many at most); a cache, not a limit.
MEMO = 400_000
UNKNOWN = 1 << 40


class Automaton:
    """first: pieces that may begin a word; rest: pieces that may continue it."""

    def __init__(self, first: list[str], rest: list[str]) -> None:
        # node 0 begins words, node 1 continues them
        self.next: list[dict[str, int]] = [{}, {}]
        token = [False, False]
        order: list[tuple[int, int, str]] = []
        for root, pieces in ((0, first), (1, rest)):
            for piece in pieces:
                u = root
                for c in piece:
                    v = self.next[u].get(c)
                    if v is None:
                        v = len(self.next)
                        self.next[u][c] = v
                        self.next.append({})
                        token.append(False)
                    u = v
                token[u] = u > 1
        self.fail = [-1] * len(self.next)
        self.pops = [0] * len(self.next)
        level = [0, 1]
        while level:
            order = [(u, v, c) for u in level for c, v in self.next[u].items()]
            for u, v, c in order:
                if token[v]:
                    self.fail[v], self.pops[v] = 1, 1
                    continue
                z, n = self.fail[u], self.pops[u]
                while z >= 0 and c not in self.next[z]:
                    n += self.pops[z]
                    z = self.fail[z]
                if z >= 0:
                    self.fail[v], self.pops[v] = self.next[z][c], n
            level = [v for _, v, _ in order]

    def count(self, word: str) -> int:
        """Pieces of a word; -1 if it can't be spelled."""
        step, fail, pops = self.next, self.fail, self.pops
        u = n = 0
        for c in word:
            while (v := step[u].get(c)) is None:
                if fail[u] < 0:
                    return -1
                n += pops[u]
                u = fail[u]
            u = v
        while u > 1:
            if fail[u] < 0:
                return -1
            n += pops[u]
            u = fail[u]
        return n if u == 1 else -1


def word_pieces(pieces: list[tuple[str, float, str]]) -> tuple[list[str], list[str]]:
    """SentencePiece's normal pieces as word pieces: those with a leading mark begin a word, those without continue it."""
    plain = [p for p, _, kind in pieces if kind == "normal"]
    return [p[1:] for p in plain if p[0] == "▁" and len(p) > 1 and "▁" not in p[1:]], [p for p in plain if "▁" not in p]


_OWN: dict[str, vocab.Memo] = {}


def token_counts(
    df: DataFrame, text_col: str = "text", vocab_file: str | None = None, keep: tuple[str, ...] | None = None
) -> DataFrame:
    """The columns ``keep`` (all but the text, if None), n_words, n_tokens and n_unknown (long)."""
    spark = df.sparkSession
    automaton = spark.sparkContext.broadcast(Automaton(*word_pieces(vocab.read_pieces(vocab_file or vocab.path(vocab.PIECES)))))
    key = uuid.uuid4().hex  # of this broadcast, in workers that see many
    new = ("n_words", "n_tokens", "n_unknown")
    others = [c for c in (keep if keep is not None else df.columns) if c != text_col and c not in new]
    schema = df.select(*others).schema
    for c in new:
        schema = schema.add(c, "long")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _OWN:
            own = automaton.value

            def one(word: bytes) -> int:
                n = own.count(word.decode())
                return n if n >= 0 else UNKNOWN + 1

            _OWN.clear()
            _OWN[key] = vocab.Memo(one, MEMO)
        of = _OWN[key].__getitem__
        for batch in batches:
            words, tokens, unknown = [], [], []
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(len(others)).to_pylist():
                    parts = (text or "").encode().split()  # of bytes, this splits at ASCII white space
                    total = sum(map(of, parts))
                    words.append(len(parts))
                    tokens.append(total % UNKNOWN)
                    unknown.append(total // UNKNOWN)
            columns = [batch.column(i) for i in range(len(others))]
            columns += [pa.array(x, pa.int64()) for x in (words, tokens, unknown)]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *new])

    return df.select(*others, text_col).mapInArrow(count, schema)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
