from __future__ import annotations

import random

import numpy as np
import pytest

from wearspan.llm import toxicity


def brute_kernel(a: str, b: str, p: toxicity.KernelParams) -> float:
    def features(word):
        codes = toxicity.spell_codes([word], p)[0]
        out: dict = {}
        n = len(codes)
        for i in range(n):
            for j in range(i + 1, n):
                for k in range(j + 1, n):
                    if k - i < p.width and min(codes[i], codes[j], codes[k]) > 0:
                        f = (codes[i], codes[j], codes[k])
                        out[f] = out.get(f, 0.0) + p.gap ** (k - i + 1)
        return out

    x, y = features(a), features(b)
    norm = sum(v * v for v in x.values()) * sum(v * v for v in y.values())
    return sum(v * y.get(f, 0.0) for f, v in x.items()) / norm**0.5 if norm else 0.0


def test_kernel_equals_enumeration():
    p = toxicity.KernelParams(power=1)
    words = ["idiot", "i.d.i.o.t", "iddiot", "banana", "aaaaaa", "x", "ab", "worthless", "w0rthless"]
    kernel = toxicity.StringKernel(words[:4], p)
    got = kernel.values(words)
    want = [[brute_kernel(w, m, p) for m in words[:4]] for w in words]
    assert np.allclose(got, want, atol=1e-5)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    syllables = ["ta", "ri", "mo", "ke", "sul", "ban", "ot", "fen", "la", "gri"]
    insults = ["blockhead", "numbskull", "nincompoop"]
    rows = []
    for i in range(600):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(40)] = rng.choice(insults)
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


@pytest.fixture(scope="module")
def model(labelled):
    return toxicity.fit(labelled)


def test_disguised_insults_are_found(spark, documents, model):
    clean = "tari moke sulban otfen la gri tata rimo " * 4
    dirty = ["n.u.m.b.s.k.u.l.l", "block-head", "numbsskull", "n u m b s k u l l", "blockhead!!", "nincompooop"]
    rows = [(i, f"{clean} {w} {clean} {w} {clean}") for i, w in enumerate(dirty)] + [(50, clean), (51, None), (52, ""), (53, clean * 300)]
    scored = {r["doc_id"]: r["toxicity_"] for r in toxicity.score(documents(rows, toxicity="x"), model).collect()}
    assert all(scored[i] >= 0.5 for i in range(len(dirty))), scored
    assert all(scored[i] < 0.5 for i in (50, 51, 52, 53)), scored
    assert scored[51] == scored[52]


def test_held_out_accuracy(labelled, model):
    scored = toxicity.score(labelled, model, to="score")
    right = scored.selectExpr("avg(cast((score >= 0.5) = (toxic = 1) AS int)) AS a").first()["a"]
    assert right > 0.97


def test_report_without_labels_or_rows(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity_report(documents([(1, "a b"), (None, "x")]), labels).collect()
    assert sorted((r["score"], r["predicted"]) for r in out) == [(0.0, 0), (0.0, 0)]
    assert toxicity.toxicity_report(documents([]), labels).count() == 0
