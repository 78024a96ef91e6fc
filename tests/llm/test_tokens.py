import random
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from basalt.llm import merge_dropout as md
from basalt.llm import packing, vocab
from basalt.llm import token_counts as tc
from tests.llm.conftest import TEXTS
from tests.oracle import DATA

ODD = [*(t or "" for t in TEXTS), "  a  b\n\tc ▁d", "▁", "a▁b ▁ ▁▁", " ", "\n", "\0 a\0b", "▁ ", "ab " * 40 + "   end  ", "<s> <unk> <0x0A>"]


@pytest.fixture(scope="module")
def pieces():
    return vocab.read_pieces(vocab.path(vocab.PIECES))


@pytest.fixture(scope="module")
def texts(spark):
    return [r["text"] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("text").limit(60).collect()]


def _ids(codec, text, ways=4):
    return np.frombuffer(b"".join(codec.encode_many(codec.keys(text, "7", ways))), "<u2").tolist()


def test_without_dropout_it_is_sentencepiece(pieces, texts):
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=vocab.path(vocab.PIECES)), md.Codec(pieces, 0.0)
    for t in [*texts, *ODD]:
        if "▁" not in t:
            assert _ids(codec, t) == sp.encode(t)


def test_dropout_is_lossless_seeded_and_varied(pieces, texts):
    codec, again, other = md.Codec(pieces, 0.2), md.Codec(pieces, 0.2), md.Codec(pieces, 0.2, seed=5)
    for t in [*texts, *ODD]:
        ids = _ids(codec, t)
        assert codec.decode(ids) == t and ids == _ids(again, t)
        keys = codec.keys(t, "7", 4)
        assert codec.encode_many(keys) == [codec.encode_stretch(k) for k in keys]
    assert sum(_ids(codec, t) != _ids(other, t) for t in texts) > len(texts) // 2


def test_every_occurrence_draws_its_own_skips(pieces):
    codec = md.Codec(pieces, 0.1)
    keys = codec.keys("different " * 3000, "7")
    got = codec.encode_many(keys)[1:-1]
    plain = md.Codec(pieces, 0.0).encode_stretch(keys[1])
    # more ways than four, and most of them rare
    assert len(set(got)) > 8 and max(set(got), key=got.count) == plain
    steps = []
    codec.encode_symbols(codec._start(keys[1][0]), 0, steps)
    # skips may lead to the same ids in the end
    assert 0.9 ** len(steps) - 0.03 < got.count(plain) / len(got) < 0.9
    assert got[:9] == [codec.encode_stretch(k) for k in keys[1:10]]
    assert codec.encode_many(codec.keys("different " * 50, "7")) != codec.encode_many(codec.keys("different " * 50, "8"))


def test_dropout_equals_a_slow_encoder(pieces, texts):
    """Of all neighbours that merge and aren't skipped the best merge, the first place of equals; again until there is none."""
    codec = md.Codec(pieces, 0.3)
    normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal"}
    order = {i: r for r, i in enumerate(sorted(normal.values(), key=lambda i: (-pieces[i][1], i)))}
    whole = set()
    for stretch, draw in [k for j, t in enumerate([*texts[:20], *ODD]) for k in codec.keys(t[:800], str(j))]:
        if len(stretch) > 60 or stretch == md._OWN_MARK:
            continue
        parts = [(i, c) for i, c in enumerate(stretch)]
        if not all(c in normal for _, c in parts):
            continue
        while True:
            merges = [(order[normal[a + b]], i, k) for k, ((i, a), (_, b)) in enumerate(zip(parts, parts[1:])) if a + b in normal]
            merges = [m for m in merges if not codec._dropped(draw, m[0], m[1])]
            if not merges:
                break
            _, i, k = min(merges)
            parts[k : k + 2] = [(i, parts[k][1] + parts[k + 1][1])]
        whole.add(stretch)
        assert np.frombuffer(codec.encode_stretch((stretch, draw)), "<u2").tolist() == [normal[p] for _, p in parts]
    assert len(whole) > 200


def test_decode_table(spark, docs, none):
    rows = docs.withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit("clash"))
    coded = md.encode(rows, check=False, keep=("text", "n_words", "ids", "doc_id"))
    back = md.decode(coded, text_col="decoded", keep=("text", "n_words")).collect()
    assert len(back) == docs.count() and all(r["decoded"] == (r["text"] or "") for r in back)
    assert sorted(str(r["n_words"]) for r in back) == sorted(str(r["n_words"]) for r in docs.collect())
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, -5, 10**6]), (4, [259 + 3, 3 + 0xC3])], "doc_id int, ids array<int>")
    out = {r["doc_id"]: r["text"] for r in md.decode(odd).collect()}
    assert out[1] == out[2] == out[3] == "" and out[4].endswith("\ufffd")
    assert md.decode(md.encode(none)).count() == 0
    assert md.op3_merge_dropout(spark, f"{DATA}/sf0.001").where("not lossless").isEmpty()


def test_encode_table(docs, none):
    out = md.encode(docs)
    assert out.count() == docs.count() and out.where("not lossless").isEmpty()
    assert {r["n_tokens"] for r in out.where("doc_id in (0, 1, 99)").collect()} == {0}
    assert md.encode(none).count() == 0


def test_counts_equal_word_piece(pieces, texts):
    first, rest = tc.word_pieces(pieces)
    automaton = tc.Automaton(first, rest)
    ids = {"[UNK]": 0}
    for p in [*first, *("##" + p for p in rest)]:
        ids.setdefault(p, len(ids))
    plain = Tokenizer(models.WordPiece(ids, unk_token="[UNK]", max_input_chars_per_word=10**9))
    rng = random.Random(2)
    words = {w.decode() for t in [*texts, *ODD] for w in t.encode().split()} | {"".join(rng.choice("abehinrst.") for _ in range(rng.randrange(1, 40))) for _ in range(2000)}
    for w in words:
        tokens = plain.encode(w).tokens
        if not w.startswith("##"):
            assert automaton.count(w) == (-1 if tokens == ["[UNK]"] else len(tokens)), w


def test_small_automaton_by_hand():
    a = tc.Automaton(["a", "abcdx"], ["b", "c", "cdy", "dz"])
    assert [a.count(w) for w in ("a", "abcdx", "abcdy", "abcdz", "abc", "abcd", "b", "ax")] == [1, 1, 3, 4, 3, -1, -1, -1]


def test_count_table(docs, none):
    out = tc.token_counts(docs, keep=("doc_id", "score")).collect()
    for r, text in zip(sorted((r for r in out if r["doc_id"] is not None and r["doc_id"] < 9), key=lambda r: r["doc_id"]), sorted([*range(9), 4])):
        assert r["n_words"] == len((TEXTS[text] or "").encode().split())
    assert tc.token_counts(none).count() == 0


def test_pieces_are_the_tokenizers(spark):
    plain = Tokenizer.from_file(vocab.path("byte_bpe_50k.json"))
    fast = packing.Tokens(vocab.path("byte_bpe_50k.json"), vocab.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(6)
    alphabet = [*"aeßéñ 's\n\t.,9", " ", "²", "ª", "\x85", "\xa0", "​", "😀", "語", "<|endoftext|>", "\r\n", "  "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)]
    texts += [r["text"] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("text").collect()] + [*ODD, "y" * 30_000]
    for t in texts:
        assert fast(t) == plain.encode(t, add_special_tokens=False).ids


def _check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, docs, none):
    rows = packing.best_fit(docs, with_ids=True).collect()
    assert _check(rows, 1024) < len(rows)
    plain = Tokenizer.from_file(vocab.path("byte_bpe_50k.json"))
    for i, t in enumerate(TEXTS):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["piece"])
        mine = mine[: len({r["piece"] for r in mine})] if i != 4 else mine[:1]
        assert [x for r in mine for x in r["ids"]] == ids
        assert all(r["length"] == 1024 for r in mine[1:]) and [r["start"] for r in mine] == packing.cut(len(ids), 1024)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in mine)
    assert packing.best_fit(none).count() == 0


def test_sweep_is_best_fit_decreasing(spark):
    rng = random.Random(8)
    for capacity in (7, 64, 1024):
        sizes = [rng.randint(1, capacity) for _ in range(400)] + [capacity // 3 + 1] * 200
        gaps: list[int] = []
        for n in sorted(sizes, reverse=True):
            fits = [g for g in gaps if g >= n]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else capacity) - n)
        df = spark.createDataFrame([(i % 50, i, n) for i, n in enumerate(sizes)], "doc_id int, piece int, length long")
        assert _check(packing.pack(df, capacity).collect(), capacity) == len(gaps)
    assert packing.sweep([], [], 9) == ([], [], [])
