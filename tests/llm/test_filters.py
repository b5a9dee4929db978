from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wearspan.llm import filters

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def plain_counts(text):
    words = WORD.findall(text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def of_texts(texts, block=4_000_000):
    array = pa.array(texts, pa.large_string())
    _, offsets, data = array.buffers()
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return filters.text_counts(data, np.frombuffer(offsets, np.int64)[: len(texts) + 1], block).T.tolist()


def random_texts(seed, n=400):
    rng = random.Random(seed)
    bits = ["a", "b", "ab", "A", "ß", "日本", "😀", " ", "  ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "#", "|x", ".", "\x00", "word", "Word"]
    return ["".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 20, 200]))) for _ in range(n)]


@pytest.mark.parametrize("block", [4_000_000, 1, 7, 64])
def test_counts_equal_plain_python(block):
    texts = [*random_texts(3), "", "", "x" * 500, " " * 500, "x " * 400 + "y" * 300]
    assert of_texts(texts, block) == [plain_counts(t) for t in texts]
    assert of_texts([]) == [] and of_texts(["", ""]) == [[0] * 5] * 2


def test_equal_hashes_do_not_make_words_equal(monkeypatch):
    monkeypatch.setattr(filters, "span_hashes", lambda data, begin, end: np.zeros(len(begin), np.uint64))
    texts = [*random_texts(9, 60), "aa ab aa ba", "ab"]
    assert of_texts(texts) == [plain_counts(t) for t in texts]


def test_a_very_long_text_and_a_very_long_word():
    text = " ".join(f"w{i % 5000}" for i in range(1_500_000)) + " " + "z" * 9_000_000
    assert of_texts([text, "b"]) == [[1_500_001, 5001, 0, len(text), 0], [1, 1, 0, 1, 0]]


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for doc, text, _ in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    parts: dict = {}
    for doc, text, source in rows:
        words, distinct, capitals, points, signs = plain_counts(text or "")
        fails = {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * points, "D": signs > 0, "E": doc is not None and doc > first[text or ""]}
        parts.setdefault(source or "", []).append((doc, {k for k, v in fails.items() if v}))
    out = []
    for part, docs in parts.items():
        removals = dict.fromkeys("ABCDE", 0)
        rows_of_part = []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, letter in enumerate(order, start=1):
                removed = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                failing = sum(letter in f for _, f in docs)
                removals[letter] += len(removed)
                rows_of_part.append((part, "".join(order), step, len(left), len(removed), failing - len(removed), sum(f == {letter} for _, f in docs), sum(d in good for d, _ in removed), sum(d in toxic for d, _ in removed)))
        out += [(*r, removals[r[1][r[2] - 1]]) for r in rows_of_part]
    return sorted(out)


def test_audit_equals_applying_the_filters(spark):
    rng = random.Random(11)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "Dd", "#", "é"]) for _ in range(rng.choice([3, 60, 80]))) for _ in range(25)]
    base += [" ".join(f"w{i}" for i in range(60)), "", None]
    rows = [(rng.choice([i, i, i, 5, None]), rng.choice(base), rng.choice(["s", "t", "", None])) for i in range(300)]
    rows += rows[:40] + [(900 + i, base[0], "s") for i in range(100)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 400, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("words", F.lit(1)).withColumn("n", F.lit("x")).withColumn("digest", F.lit(2))
    found = filters.filter_audit(docs.repartition(5), spark.createDataFrame(labels, LABELS))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filters.filter_audit(docs, labels).count() == 0
    assert filters.filter_audit(spark.createDataFrame([(1, None, None)], DOCS), labels).count() == 600


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a B", "s"), (1, "a B", "s"), (2, None, "t")], DOCS)
    rows = sorted(tuple(r) for r in filters.count_words(docs).select("doc_id", "source", *filters.COUNTS).collect())
    assert rows == [(1, "s", 2, 2, 1, 3, 0)] * 2 + [(2, "t", 0, 0, 0, 0, 0)]
