from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearspan.llm import packing, rans
from wearspan.llm.queries import QUERIES
from wearspan.session import scratch_path


@pytest.fixture(scope="module")
def vocabulary():
    import public_tokenizers

    return packing.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def block_of(ids, before=0):
    pieces = np.array([(0, 5, 0, 0, len(ids), len(ids))], rans.PIECE)
    return rans.Block(3, 1, before, pieces, np.asarray(ids, np.uint32))


def table_of(ids, size=50_257):
    return rans.Frequencies.of(rans.quantised(np.bincount(ids, minlength=size)))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 129, 5_000, 70_001])
@pytest.mark.parametrize("kind", ["zipf", "flat", "one"])
def test_blocks_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"zipf": lambda: np.minimum(rng.zipf(1.3, n), 50_256), "flat": lambda: rng.integers(0, 50_257, n), "one": lambda: np.full(n, 7)}[kind]()
    table = table_of(ids)
    for p in (rans.RansParams(), rans.RansParams(lanes=4, checkpoint=5), rans.RansParams(lanes=1, checkpoint=1 << 20)):
        data = rans.encode_block(block_of(ids), table, p)
        block = rans.OpenBlock.of(data, table)
        assert np.array_equal(block.ids(table), ids)
        for first in {0, n // 3, n - 1}:
            end = min(n, first + 100)
            assert np.array_equal(block.some(first, end, table), ids[first:end])


def test_the_size_is_near_the_entropy():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.4, 1 << 18), 50_256)
    share = np.bincount(ids) / len(ids)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(ids) / 8
    assert len(rans.encode_block(block_of(ids), table_of(ids))) < 1.06 * entropy


def test_damage_is_an_error():
    ids = np.arange(3_000) % 900
    table = table_of(ids)
    data = rans.encode_block(block_of(ids), table)
    for place in (0, 9, 40, rans.HEAD.size + 3, len(data) // 2, len(data) - 1):
        changed = bytearray(data)
        changed[place] ^= 4
        with pytest.raises(ValueError):
            rans.OpenBlock.of(bytes(changed), table).ids(table)
    for torn in (data[:-1], data[:20], b""):
        with pytest.raises(ValueError):
            rans.OpenBlock.of(torn, table)
    with pytest.raises(ValueError, match="another table"):
        rans.OpenBlock.of(data, table_of(np.arange(1_000)))
    with pytest.raises(ValueError, match="no frequency"):
        rans.encode_block(block_of([1_000]), table)


def test_frequencies_add_up():
    for counts in ([0, 0], [5], [1, 10**15, 0, 3], [1] * 50_257, [10**12] * 3):
        out = rans.quantised(np.array(counts, np.int64))
        assert out.sum() == (1 << rans.BITS if sum(counts) else 0)
        assert ((out > 0) == (np.array(counts) > 0)).all()
    with pytest.raises(ValueError):
        rans.quantised(np.ones(9, np.int64), 3)


def test_checksums_of_pieces_add_up():
    rng = random.Random(4)
    data = rng.randbytes(5_000)
    for cuts in ([0, 5_000], [0, 1, 4_999, 5_000], [0, 17, 17, 1_024, 3_000, 5_000]):
        total = 0
        for a, b in zip(cuts, cuts[1:]):
            total ^= rans.crc_behind(zlib.crc32(data[a:b]), len(data) - b)
        assert total == zlib.crc32(data)


def plain(rows, tokenizer):
    """(doc_id, start, n_tokens, crc) of rows in order."""
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read_back(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_folder_round_trip(spark, documents, vocabulary, tokenizer):
    texts = [(3 * i, f"Some words {i % 7} " * (i % 23)) for i in range(150)] + [(1, None), (2, ""), (10, "long ones " * 3_000), (700, "é <|endoftext|> 日本")]
    random.Random(1).shuffle(texts)
    path = scratch_path(spark, "tokens")
    docs = documents(texts, part=1, seq=2, ids="x", h=3, r=4).repartition(6)
    rans.write_tokens(docs, path, vocabulary, p=rans.RansParams(block_ids=1_000, lanes=8, checkpoint=16))
    wanted = plain(sorted(texts, key=lambda t: t[0]), tokenizer)
    assert read_back(rans.read_documents(spark, path)) == wanted
    whole = rans.read_pieces(spark, path, with_ids=True).collect()
    assert len(whole) > len(texts) and sum(r["length"] for r in whole) == sum(w[2] for w in wanted)
    stream = [i for _, t in sorted(texts, key=lambda t: t[0]) for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]]
    for first, end in ((0, 10), (1_234, 5_678), (len(stream) - 5, len(stream) + 50), (7, 7)):
        found = sorted(rans.read_range(spark, path, first, end).collect(), key=lambda r: r["start"])
        assert [i for r in found for i in r["ids"]] == stream[first:end]


def test_repeated_and_missing_ids(spark, documents, vocabulary, tokenizer):
    texts = [(5, "same row")] * 200 + [(5, "other text"), (None, "no id"), (None, None), (9, "last")]
    path = scratch_path(spark, "tokens")
    rans.write_tokens(documents(texts).repartition(4), path, vocabulary, p=rans.RansParams(block_ids=64))
    rows = read_back(rans.read_documents(spark, path))
    assert sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in rows) == sorted((r[0] is not None, r[0] or 0, r[2], r[3]) for r in plain(texts, tokenizer))
    assert [r[0] for r in rows] == [None] * 2 + [5] * 201 + [9]
    at = 0
    for r in rows:
        assert r[1] == at
        at += r[2]


def test_empty_table(spark, documents, vocabulary):
    path = scratch_path(spark, "tokens")
    rans.write_tokens(documents([]), path, vocabulary)
    assert rans.read_documents(spark, path).count() == 0


def test_a_damaged_folder_is_refused(spark, documents, vocabulary):
    path = scratch_path(spark, "tokens")
    rans.write_tokens(documents([(i, f"text {i}") for i in range(50)]), path, vocabulary)
    bad = spark.read.parquet(f"{path}/blocks").withColumn("data", F.expr("overlay(data PLACING X'00FF00' FROM 90)"))
    bad.write.parquet(f"{path}-bad/blocks")
    for name in ("table", "parts"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{path}-bad/{name}")
    with pytest.raises(Exception, match="checksum"):
        rans.read_documents(spark, f"{path}-bad").collect()


def test_whole_table(spark, small_dir, tokenizer):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect())
    assert read_back(QUERIES["op13_rans_output"](spark, small_dir)) == plain(rows, tokenizer)
