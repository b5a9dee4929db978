from __future__ import annotations

import random

import pytest

from wearspan.operators.metrics import (
    average_f1,
    baseline,
    class_report,
    confusion,
    confusion_cells,
    diagnostics,
    gate_metrics,
    weighted_log_loss,
)


def pairs(seed, n=400, classes=(0, 1, 2)):
    rng = random.Random(seed)
    return [(rng.choice(classes), rng.choice((0, 1, 2))) for _ in range(n)]


def f_beta(rows, k, beta):
    tp = sum(t == k and p == k for t, p in rows)
    fn = sum(t == k and p != k for t, p in rows)
    fp = sum(t != k and p == k for t, p in rows)
    bottom = (1 + beta**2) * tp + beta**2 * fn + fp
    return (1 + beta**2) * tp / bottom if bottom else 0.0


def counts(spark, rows):
    return confusion(spark.createDataFrame(rows, "t int, p int"), "t", "p")


@pytest.mark.parametrize("classes", [(0, 1, 2), (0, 1), (2,), (0, 0, 0, 0, 1, 2)])
def test_metrics_equal_brute_force(spark, classes):
    rows = pairs(11, classes=classes)
    total = len(rows)
    support = [sum(t == k for t, _ in rows) for k in range(3)]
    table = counts(spark, rows)
    gate = gate_metrics(table).first()
    assert gate["accuracy"] == pytest.approx(sum(t == p for t, p in rows) / total)
    assert gate["f2_weighted"] == pytest.approx(
        sum(f_beta(rows, k, 2) * support[k] for k in range(3)) / total
    )
    hit = sum(t == p == 2 for t, p in rows)
    assert gate["critical_recall"] == pytest.approx(hit / support[2] if support[2] else 0.0)
    averages = average_f1(table).first()
    assert averages["f1_macro"] == pytest.approx(sum(f_beta(rows, k, 1) for k in range(3)) / 3)
    for r in class_report(table).collect():
        assert r["support"] == support[r["class"]]
        assert r["f1"] == pytest.approx(f_beta(rows, r["class"], 1))
    cells = {(r["truth"], r["predicted"]): r["rows"] for r in confusion_cells(table).collect()}
    assert len(cells) == 9
    assert cells == {
        (t, p): sum(x == (t, p) for x in rows) for t in range(3) for p in range(3)
    }


def test_published_always_healthy_baseline(spark):
    rows = [(0, 0)] * 682 + [(1, 0)] * 150 + [(2, 0)] * 168
    table = counts(spark, rows)
    gate = gate_metrics(table).first()
    assert gate["accuracy"] == pytest.approx(0.682)
    assert gate["f2_weighted"] == pytest.approx(0.623, abs=2e-3)
    assert gate["critical_recall"] == 0.0
    assert average_f1(table).first()["f1_macro"] == pytest.approx(0.270, abs=1e-3)
    base = baseline(table, 0).first()
    assert base["baseline_accuracy"] == pytest.approx(0.682)
    assert base["baseline_f1_macro"] == pytest.approx(0.270, abs=1e-3)
    assert base["baseline_class"] == "Healthy"


def test_diagnostics_agree_with_their_parts(spark):
    table = counts(spark, pairs(5))
    whole, report = diagnostics(table, 1).first(), class_report(table).collect()
    for r in report:
        for name in ("precision", "recall", "f1", "support"):
            assert whole[f"{r['name'].lower()}_{name}"] == r[name]
    assert sum(map(sum, whole["confusion"])) == 400


def test_log_loss(spark):
    df = spark.createDataFrame(
        [(0, [0.5, 0.25, 0.25], 1.0), (2, [0.5, 0.25, 0.25], 3.0)],
        "t int, p array<double>, w double",
    )
    got = weighted_log_loss(df, "t", "p", "w").first()[0]
    assert got == pytest.approx((0.6931471805599453 + 3 * 1.3862943611198906) / 4)
