from __future__ import annotations

import math
import random
import zlib

import pytest

from wearspan.llm import sharding


@pytest.mark.parametrize("hot", [0, 300])
def test_bytes_are_near_equal_and_slots_gapless(documents, hot):
    rng = random.Random(2)
    rows = [(i, "é" * rng.randrange(1, 400)) for i in range(900)] + [(5000, "same row " * 20)] * hot
    out = sharding.shard_documents(documents(rows, shard=9, node="n"), shards=6, per_bucket=50).collect()
    assert len(out) == len(rows)
    totals, slots = [0] * 6, [[] for _ in range(6)]
    for r in out:
        totals[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(totals) - min(totals) <= 2500
    texts = dict(rows)
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in out)


def test_small_and_odd_tables(documents):
    assert sharding.shard_documents(documents([])).count() == 0
    out = sharding.shard_documents(documents([(None, None), (1, ""), (2, "x")]), shards=4).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in out) == [(8, 0), (8, 0), (9, zlib.crc32(b"x"))]
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}


SOURCES = ["https://a.example/" + name for name in ("news", "notes", "wiki", "zoo")]


def varied(n=1500):
    """Many sources with one beginning, odd lengths, repeated rows and NULL metadata."""
    rng = random.Random(5)
    rows = []
    for i in range(n):
        source = rng.choice([SOURCES[0]] * 3 + SOURCES) if i % 50 else None
        words = "copied text " * 9 if i % 22 == 11 else f"text {i} " * rng.randrange(1, 60)
        rows.append((i // 2 if i % 40 == 0 else i, words, source, rng.choice(["en", "de", None]), len(words)))
    return rows + rows[:30] * 3


def table_of(spark, rows, parts):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int").repartition(parts)


def codes(values, number):
    known = [number(v) for v in values if v is not None]
    low, high = min(known), max(known)
    scale = (2**16 - 1) / (high - low) if high > low else 0.0
    return [0 if v is None else math.floor((number(v) - low) * scale + 0.5) for v in values]


def text_number(shared):
    return lambda v: float(int.from_bytes(v.encode()[shared:].ljust(7, b"\0")[:7], "big"))


def test_every_cut_is_the_weighted_median_of_the_widest_dimension(spark):
    rows = varied()
    shards, tolerance = 6, 0.0005
    placed: dict = {}
    for r in sharding.shard_documents(table_of(spark, rows, 3), shards=shards, per_bucket=100).collect():
        placed.setdefault((r["doc_id"], r["text_crc32"]), []).append(r["shard"])
    points = zip(codes([r[2] for r in rows], text_number(len("https://a.example/"))), codes([r[3] for r in rows], text_number(0)), codes([r[4] for r in rows], math.log1p), strict=True)
    groups: dict = {}
    for row, point in zip(rows, points, strict=True):
        groups.setdefault((row[0], zlib.crc32(row[1].encode())), []).append((len(row[1].encode()) + 8, point))
    # Rows of one id and text have one set of metadata here, so that it does not matter which is which.
    items = [(s, size, point) for key, held in groups.items() for s, (size, point) in zip(sorted(placed[key]), held, strict=True)]
    assert len(items) == len(rows) and all(len({p for _, p in held}) == 1 for held in groups.values())
    dimensions = set()

    def check(first, count, inside):
        if count == 1:
            return
        spans = [max(p[d] for *_, p in inside) - min(p[d] for *_, p in inside) for d in range(3)]
        widest = spans.index(max(spans))
        dimensions.add(widest)
        middle = first + count // 2
        left, right = [i for i in inside if i[0] < middle], [i for i in inside if i[0] >= middle]
        assert max(i[2][widest] for i in left) <= min(i[2][widest] for i in right)
        wanted = sum(i[1] for i in inside) * (count // 2) / count
        assert abs(sum(i[1] for i in left) - wanted) <= max(i[1] for i in inside) + tolerance * wanted
        check(first, count // 2, left)
        check(middle, count - count // 2, right)

    check(0, shards, items)
    assert len(dimensions) > 1


def test_the_files_do_not_matter(spark):
    rows = varied(600)

    def result(parts, listed):
        return sorted(map(tuple, sharding.shard_documents(table_of(spark, listed, parts), shards=5, per_bucket=60).drop("grown_shard").collect()))

    assert result(1, rows) == result(7, rows[::-1])


def test_texts_stay_together_but_where_a_cut_passes(spark):
    rows = [(i, f"text {i // 4} " * 10, "s", "en", 100) for i in range(2000)]
    shard_of: dict = {}
    for r in sharding.shard_documents(table_of(spark, rows, 4), shards=8, per_bucket=100).collect():
        shard_of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in shard_of.values()) <= 7


def test_a_hot_row_is_numbered_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 7)
    out = sharding.shard_documents(table_of(spark, [(1, "hot", "s", "en", 3)] * 100 + [(None, None, None, None, None)] * 3, 2), shards=4, per_bucket=10).collect()
    assert len(out) == 103
    totals = [sum(r["size"] for r in out if r["shard"] == k) for k in range(4)]
    assert max(totals) - min(totals) <= 2 * 11
    assert all(sorted(r["slot"] for r in out if r["shard"] == k) == list(range(sum(r["shard"] == k for r in out))) for k in range(4))
