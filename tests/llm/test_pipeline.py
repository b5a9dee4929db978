"""The stages on a small corpus, each against a plain version."""

from __future__ import annotations

import random

import pytest
from test_near import brute

import corpus_pipeline
from wearspan.llm.frames import saved

INSULTS = ("blockhead", "numbskull")


@pytest.fixture(scope="module")
def folder(spark, documents, tmp_path_factory):
    rng = random.Random(12)
    syllables = ["ta", "ri", "mo", "ke", "sul", "ban", "ot", "fen", "la", "gri"]
    rows, labels = [], []
    for i in range(400):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(30)]
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            words[rng.randrange(30)] = rng.choice(INSULTS)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    clean = [t for i, t in rows if i % 5]
    rows += [(500 + i, clean[i] + " added") for i in range(20)] + [(600, clean[30])] * 2
    rows += [(700, 'set token = "abcdef123456" here ' + " ".join(reversed(clean[40].split()))), (701, None), (702, ""), (None, clean[50] + " q")]
    path = str(tmp_path_factory.mktemp("corpus"))
    documents(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_do_what_they_say(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, texts = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = saved(stage(spark, docs, folder), name)
        assert kept.columns == columns and kept.schema.simpleString() == docs.schema.simpleString()
        before, after = ([(r["doc_id"], r["text"]) for r in d.collect()] for d in (docs, kept))
        if name == "toxicity":
            gone = set(before) - set(after)
            assert all(any(w in t for w in INSULTS) for _, t in gone) and len(gone) >= 78
            assert len(after) == len(before) - len(gone)
        elif name == "near_dedup":
            named = [(i, t) for i, t in before if i is not None]
            single = {i: t for i, t in reversed(named) if i != 600}
            wanted = {i for i, _, root in brute(sorted(single.items()), 80) if i == root}
            assert {i for i, _ in after if i not in (600, None)} == wanted
            assert sum(i == 600 for i, _ in after) <= 1 and sum(i is None for i, _ in after) == 1
        else:
            texts = {i: t for i, t in after}
            assert "abcdef123456" not in texts[700] and "[secret]" in texts[700] and len(after) == len(before)
        docs = kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(texts)
    totals = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in totals) <= 1024


def test_run_and_empty_corpus(spark, folder, documents, tmp_path):
    assert corpus_pipeline.run(spark, folder).count() > 300
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_different_texts_of_a_repeated_id_are_documents_of_their_own(spark, documents, tmp_path):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    rows = [(5, a), (5, b), (5, b), (5, None), (5, ""), (9, a + " more"), (9, c), (12, d), (13, d + " more"), (None, b), (None, None)]
    docs = documents(rows, row=1, number=2, digest="x", _digest="y")
    kept = corpus_pipeline.one_of_each_group(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(5, a), (5, b), (5, None), (5, ""), (9, c), (12, d), (None, b), (None, None)], key=repr)
