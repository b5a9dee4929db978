from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from wearspan.llm import packing
from wearspan.llm.bytebpe import ByteBpe


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return packing.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_a_fresh_tokenizer(vocabulary, tokenizer):
    bpe = ByteBpe(vocabulary)
    texts = ["plain words, and more.", " lead", "trail ", "a  b", "a \n b", "x\n\n\ty", "日本語 mixed", "it's 12,345!", "é è", "<|endoftext|> text", "a <|endoftext|> b", " ", "\n", "a b c", "ends\n next", ""]
    rng = random.Random(5)
    bits = ["a", "b", "é", "º", "²", "'", "s", "'s", "'ll", " ", "  ", "\n", "\n\n", "\t", "\xa0", "$", "1", ".", "It", "日", "ß", "\u0301", "<|endoftext|>"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for text in texts:
        assert np.frombuffer(bpe.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert tokenizer.encode("a <|endoftext|> b", add_special_tokens=False).ids.count(50256) == 1


def check(packed, texts, exact, capacity):
    rows = packed.collect()
    by_bin: dict = {}
    for r in rows:
        by_bin.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_bin.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, text in texts:
        ids = [*exact.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted((r for r in by_doc[i]), key=lambda r: r["start"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert all(r["length"] == capacity for r in own[1:]) and sum(r["length"] for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    return len(by_bin), sum(r["length"] for r in rows)


def test_every_piece_is_placed(documents, vocabulary, tokenizer):
    texts = [(i, "some words to pack " * (i % 37)) for i in range(300)] + [(400, None), (401, ""), (402, "long text " * 2000), (403, "cut <|endoftext|> here")]
    df = documents(texts, piece=1, sequence_id=2)
    pieces = packing.token_pieces(df, vocabulary, 64)
    bins, total = check(packing.pack_pieces(pieces, 64, per_task=40), texts, tokenizer, 64)
    assert bins <= 1.06 * total / 64 + 2
    assert packing.pack_documents(documents([]), vocabulary).count() == 0


def test_bins_that_nothing_fits_end_the_rounds(spark):
    rows = [(i, 0, 0, 40, i) for i in range(500)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    packed = packing.pack_pieces(pieces, 64, per_task=50)
    assert packed.count() == 500 and packed.select("sequence_id").distinct().count() == 500


def test_repeated_rows_are_packed_each(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 10, 5)] * 30 + [(None, 0, 0, 3, 1)], packing.PIECES)
    packed = packing.pack_pieces(pieces, 32)
    assert packed.count() == 31 and packed.agg({"length": "sum"}).first()[0] == 303


def test_best_fit_takes_the_fullest_bin():
    bins, offsets = packing.best_fit(np.array([6, 5, 4, 3]), 10)
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 6, 5]
