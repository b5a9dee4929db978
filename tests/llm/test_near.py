from __future__ import annotations

import random

import numpy as np

from wearspan.llm import minhash, vectors
from wearspan.llm.components import components


def brute(rows, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for x in range(len(rows)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * len(sets[x] | sets[y]):
                a, b = find(rows[x][0]), find(rows[y][0])
                parent[max(a, b)] = min(a, b)
    return {(i, len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True)}


def corpus(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = rng.choices(words, k=120)
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(120)]
    for i in range(90):  # a group around a text that is not itself in the table
        copy = list(base)
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(120)] = rng.choice(words)
        rows.append((200 + i, " ".join(copy)))
    rows += [(400 + i, rows[5][1].upper()) for i in range(30)]
    rows += [(500, None), (501, ""), (502, " \t\n "), (503, "one two"), (504, "ONE  two"), (505, "one two three four five"), (506, "x" * 50_000)]
    return rows


def test_components_equal_brute_force(documents):
    rows = corpus()
    out = minhash.near_components(documents(rows, component_id=3, node=1), minhash.NearParams(block=32))
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect()} == brute(rows, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_repeated_ids_link_through_all_their_texts(documents):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b), (None, a), (7, "alone here")]
    out = minhash.near_components(documents(rows)).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in out} == {1: 1, 2: 1, 3: 1, None: None, 7: 7}


def test_nothing_to_compare(documents):
    assert minhash.near_components(documents([])).count() == 0
    assert minhash.near_components(documents([(1, None), (2, "")])).where("kept").count() == 2


def test_estimate_is_corrected_for_collisions():
    rng = np.random.default_rng(0)
    for common in (300, 700, 900):
        shared = rng.integers(0, 2**63, common, dtype=np.uint64)
        x, y = (np.concatenate([shared, rng.integers(0, 2**63, 1000 - common, dtype=np.uint64)]) for _ in range(2))
        truth = common / (2000 - common)
        minima = minhash.minima_of([x, y], 2048, 5)
        for bits in (1, 4):
            sig = minhash.packed(minima, bits)
            equal = sum(((int(p) >> bits * k) & (2**bits - 1)) == ((int(q) >> bits * k) & (2**bits - 1)) for p, q in zip(*sig, strict=True) for k in range(64 // bits)) / 2048
            assert abs((equal - 2.0**-bits) / (1 - 2.0**-bits) - truth) < 0.06


def test_stars_find_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(rng.randrange(200, 230), rng.randrange(200, 230)) for _ in range(20)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root: dict = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: root[n] for n in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    center = rng.standard_normal(16)
    rows = [(i, (center + 0.25 * rng.standard_normal(16)).tolist(), i % 2) for i in range(160)]
    rows += [(200 + i, rng.standard_normal(16).tolist(), 0) for i in range(60)]
    rows += [(300 + i, rows[3][1], 1) for i in range(40)] + [(340, [2 * v for v in rows[3][1]], 1)]
    odd = [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] + [1.0] * 15, 0), (403, [None] + [1.0] * 15, 0), (404, rows[3][1], None), (405, [], 0), (406, rows[3][1][:8], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    out = {r["vec_id"]: r for r in vectors.near_vectors(df, vectors.StableParams(block=64)).collect()}
    x = np.array([v for _, v, _ in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    label = np.array([k for *_, k in rows])
    linked = (unit @ unit.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    ids = np.array([i for i, *_ in rows])
    root = ids.copy()
    for _ in range(len(ids)):
        root = np.array([min(root[i], root[linked[i]].min(initial=10**9)) for i in range(len(ids))])
    for i, n, c in zip(ids, linked.sum(1), root, strict=True):
        assert (out[i]["n_links"], out[i]["component_id"], out[i]["kept"]) == (n, c, i == c)
    assert all((out[i]["n_links"], out[i]["component_id"]) == (0, i) for i, *_ in odd)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_long_vectors_link_like_any_other(spark, monkeypatch):
    rng = np.random.default_rng(2)
    long = rng.standard_normal(40_000)
    rows = [(i, (long + 0.1 * i * rng.standard_normal(40_000)).tolist(), 0, "x") for i in range(1, 4)] + [(9, rng.standard_normal(40_000).tolist(), 0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node string").selectExpr("*", "1 AS weight", "'k' AS key", "2 AS size")
    out = {r["vec_id"]: tuple(r)[1:] for r in vectors.near_vectors(df).collect()}
    unit = np.array([v for _, v, *_ in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.93
    assert [out[i][0] for i in (1, 2, 3, 9)] == (linked.sum(1) - 1).tolist() and out[1][0] > 0
    assert out[9] == (0, 9, True) and out[2][1] == 1
    p = vectors.StableParams()
    whole = vectors.projected(unit[:, :100], p, {})
    monkeypatch.setattr(vectors, "SLICE", 7)
    assert np.allclose(vectors.projected(unit[:, :100], p, {}), whole)
