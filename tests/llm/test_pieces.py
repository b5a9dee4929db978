from __future__ import annotations

import itertools
import math
import random
import struct

import pytest

from wearspan.llm import pieces

WORDS = ["", "a", "  two  blanks ", "naïve café", "日本語 text", "\U0001f600!", "▁ marker ▁", "tab\tline\n", "x" * 3000]


@pytest.fixture(scope="module")
def small_table():
    spelled = ["", " a", " ab", "a", "b", "c", "ab", "bc", "abc", " "]
    scores = [math.nan, -1.0, -1.5, -2.0, -2.0, -2.5, -2.2, -2.3, -4.0, -3.0]
    offset = len(spelled)
    return pieces.PieceTable([s.encode() for s in spelled] + [bytes([b]) for b in range(256)], scores + [math.nan] * 256, list(range(offset, offset + 256)))


@pytest.fixture(scope="module")
def public_table():
    import public_tokenizers

    return pieces.read_table(public_tokenizers.path("piece_bpe_32k.model"), zipf=True)


def test_trie_finds_exactly_its_words():
    rng = random.Random(3)
    words = {bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))): i for i, _ in enumerate(range(2000))}
    trie = pieces.DoubleArray(words)

    def value(word):
        state = 0
        for c in word:
            step = trie.base[state] + c
            if step >= len(trie.check) or trie.check[step] != state:
                return -1
            state = step
        return trie.value[state]

    assert all(value(w) == i for w, i in words.items())
    assert all(value(w + b"\x00") == words.get(w + b"\x00", -1) for w in words)


def test_best_path_equals_all_segmentations(small_table):
    model = pieces.PieceModel(small_table)
    scores = {p: s for p, s in zip(small_table.pieces, small_table.scores, strict=True) if s == s and p}
    for n in range(1, 7):
        for letters in itertools.product(b"abc ", repeat=n):
            word = bytes(letters)
            best = -math.inf
            for cuts in itertools.product((0, 1), repeat=n - 1):
                ends = [i + 1 for i, c in enumerate(cuts) if c] + [n]
                parts = [word[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                if all(p in scores for p in parts):
                    best = max(best, sum(scores[p] for p in parts))
            assert model.best_path(word)[1] == pytest.approx(best)


def test_uncovered_characters_become_bytes(small_table):
    model = pieces.PieceModel(small_table)
    ids = list(struct.unpack("<4i", model.encode("aé")[:16])) if len(model.encode("aé")) == 16 else list(struct.unpack(f"<{len(model.encode('aé')) // 4}i", model.encode("aé")))
    assert ids[-2:] == [small_table.byte_ids[0xC3], small_table.byte_ids[0xA9]]


def test_round_trip_whole_table(spark, documents, public_table):
    rows = list(enumerate(WORDS)) + [(90, None), (1, "a")]
    out = pieces.tokens_and_round_trip(documents(rows, ids=5), public_table).collect()
    assert len(out) == len(rows)
    assert all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in out)
    assert {r["doc_id"]: r["n_tokens"] for r in out}[90] == 0
    assert pieces.tokens_and_round_trip(documents([]), public_table).count() == 0


def test_encode_and_decode_keep_columns(spark, documents, public_table):
    df = documents([(1, "plain words"), (2, None), (3, "")], ids=7, decoded="x")
    coded = pieces.encode(df, public_table)
    assert coded.columns == [*df.columns, "ids_"]
    back = pieces.decode(coded, public_table, "ids_")
    got = {r["doc_id"]: (r["decoded_"], r["ids"]) for r in back.collect()}
    assert got == {1: ("plain words", 7), 2: (None, 7), 3: ("", 7)}


def test_words_are_independent(public_table):
    model = pieces.PieceModel(public_table)
    text = "the cat  sat on   a mat. 12 3"
    whole = pieces.PieceModel(public_table)
    whole.by_word = False
    assert model.encode(text) == whole.encode(text)
