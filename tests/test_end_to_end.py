from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from helpers import write_fleet
from pyspark.sql import functions as F

from wearspan.operators.linear import score_linear
from wearspan.operators.scoring import audit_rows, critical_above, score_windows
from wearspan.operators.selection import GateFailed
from wearspan.params import JobParams
from wearspan.plans.features import prepare
from wearspan.plans.score import score, score_table
from wearspan.plans.train import train_and_evaluate
from wearspan.schemas import CLASS_NAMES
from wearspan.sources.ledger import InconsistentArtifacts, Ledger, NoChampion
from wearspan.sources.tables import feature_names, read_manifest, read_windows

AS_OF = datetime(2024, 6, 1)
LIVES = (92, 95, 100, 105, 110, 130)
WINDOWS = sum(life - 29 for life in LIVES)
OPEN = {"f2_threshold": 0.0, "critical_recall_threshold": 0.0}
SHUT = {"f2_threshold": 1.0, "critical_recall_threshold": 1.0}


def params(**changes):
    base = {"val_split": 0.34, "max_iter": 8, "reg_params": (0.01, 0.1)}
    return JobParams(**{**base, **changes})


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    write_fleet(folder / "train_FD001.txt", LIVES)
    prepare(spark, str(folder), params(), as_of=AS_OF)
    return str(folder)


@pytest.fixture(scope="module")
def champion_run(spark, prepared, tmp_path_factory):
    ledger = Ledger(spark, str(tmp_path_factory.mktemp("ledger")))
    return ledger, train_and_evaluate(spark, prepared, ledger, params(**OPEN))


def test_window_table_content(spark, prepared):
    rows = read_windows(spark, prepared)
    assert rows.count() == WINDOWS
    per_engine = rows.groupBy("engine_id").pivot("failure_type", [0, 1, 2]).count().collect()
    assert {tuple(r) for r in per_engine} == {(f"FD001_{i}", life - 90, 30, 31) for i, life in enumerate(LIVES, 1)}
    assert {r[0] for r in rows.select(F.size("windowed_features")).distinct().collect()} == {720}
    assert len(feature_names(read_manifest(spark, prepared))) == 24
    times = rows.agg(F.min("event_timestamp"), F.max("event_timestamp"), F.countDistinct("event_timestamp"), F.max("created_timestamp")).first()
    assert times[0] == datetime(2024, 5, 31, 1)
    assert (times[1] - times[0]).total_seconds() == 10 * (WINDOWS - 1)
    assert times[2] == WINDOWS
    assert times[3] == AS_OF


def test_a_passing_run_becomes_champion(spark, champion_run):
    ledger, run = champion_run
    assert run["outcome"] == "promoted"
    assert ledger.champion("wear_classifier", 30).run_id == run["run_id"]
    metrics = {r["metric"] for r in ledger.metrics().collect()}
    assert {
        "best_val_f2_weighted",
        "test_f2_weighted",
        "test_critical_recall",
        "test_f1_macro",
        "test_alert_recall",
        "baseline_test_f1_macro",
        "train_loss",
    } <= metrics
    tags = {r["name"]: r["value"] for r in ledger.tags().collect()}
    assert tags["quality_gate_passed"] == "True"
    assert tags["fingerprint"] == run["fingerprint"]
    assert {r["name"] for r in ledger.params().collect()} >= {"window_size", "train_samples", "test_samples"}
    assert run["f1_macro"] > run["baseline_f1_macro"]


def test_every_window_is_scored(spark, prepared, champion_run):
    ledger, _ = champion_run
    answers = score_table(read_windows(spark, prepared), ledger.champion("wear_classifier", 30))
    rows = answers.collect()
    assert len(rows) == WINDOWS
    for r in rows:
        assert list(r["probabilities"]) == list(CLASS_NAMES)
        assert sum(r["probabilities"].values()) == pytest.approx(1.0, abs=1e-4)
        best = max(r["probabilities"].values())
        assert r["probabilities"][r["prediction"]] == pytest.approx(best, abs=1e-6)
    assert set(audit_rows(answers).columns) == {"engine_id", "prediction", "model_version"}
    assert critical_above(answers, 0.3).count() == sum(r["probabilities"]["Critical"] > 0.3 for r in rows)


def test_the_model_table_scores_like_the_model(spark, prepared, champion_run):
    ledger, run = champion_run
    champion = ledger.champion("wear_classifier", 30)
    windows = read_windows(spark, prepared)
    keys = ["engine_id", "event_timestamp"]
    by_table = score_linear(windows, ledger.linear_model(run["run_id"]), champion.scaler, "windowed_features")
    by_model = score_windows(windows, champion.model, champion.scaler, "windowed_features")
    plan = by_table._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Exchange" not in plan
    both = by_table.select(*keys, "probabilities", "predicted").join(
        by_model.select(*keys, F.col("probabilities").alias("p"), F.col("predicted").alias("c")), keys
    )
    far = F.exists(F.zip_with("probabilities", "p", lambda x, y: F.abs(x - y) > 1e-9), lambda b: b)
    assert both.count() == WINDOWS and both.filter(far | (F.col("predicted") != F.col("c"))).count() == 0


def test_requests_are_scored_like_the_table(spark, prepared, champion_run):
    ledger, _ = champion_run
    windows = read_windows(spark, prepared)
    matrix = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda i: F.slice("windowed_features", i * 24 + 1, F.lit(24)))
    requests = windows.select("engine_id", matrix.cast("array<array<double>>").alias("readings"))
    bad = requests.limit(3).withColumn("readings", F.slice("readings", 1, 29))
    done = score(requests.unionByName(bad), ledger, "wear_classifier", 30)
    assert done.answers.count() == WINDOWS
    assert {r["reasons"] for r in done.rejected.collect()} == {"readings:shape"}
    champion = ledger.champion("wear_classifier", 30)
    expected = score_table(windows, champion)
    keys = ["engine_id", "prediction", F.map_values("probabilities").alias("p")]
    assert sorted(map(str, done.answers.select(keys).collect())) == sorted(map(str, expected.select(keys).collect()))


def test_same_data_gives_the_same_fingerprint_and_replaces_on_equal_f2(spark, prepared, champion_run):
    ledger, first = champion_run
    again = train_and_evaluate(spark, prepared, ledger, params(**OPEN))
    assert again["fingerprint"] == first["fingerprint"]
    assert again["f2_weighted"] == first["f2_weighted"]
    assert (again["reason"], again["version"]) == ("not_worse", first["version"] + 1)


def test_a_rejected_run_is_logged_and_never_promoted(spark, prepared, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    run = train_and_evaluate(spark, prepared, ledger, params(**SHUT, enforce_gate=False))
    assert run["outcome"] == "gate_failed"
    assert ledger.promotions().count() == 0
    with pytest.raises(NoChampion):
        ledger.champion("wear_classifier", 30)
    with pytest.raises(GateFailed):
        train_and_evaluate(spark, prepared, ledger, params(**SHUT))
    assert ledger.tags().filter("name = 'outcome'").count() == 2


def test_inconsistent_artifacts_are_refused(spark, champion_run, tmp_path):
    ledger, run = champion_run
    other = Ledger(spark, str(tmp_path))
    champion = ledger.champion("wear_classifier", 30)
    scaler = ledger.scalers().filter(F.col("run_id") == run["run_id"]).drop("run_id").limit(23)
    other.save_model("broken", champion.model, scaler, 30, 24)
    other.promote("wear_classifier", "broken")
    with pytest.raises(InconsistentArtifacts, match="23 features"):
        other.champion("wear_classifier", 30)


def test_an_engine_sample_checks_all_engines(spark, tmp_path):
    write_fleet(tmp_path / "train_FD001.txt", [40, 42, 44, 46])
    write_fleet(tmp_path / "train_FD002.txt", [41, 43, 45, 47], seed=1)
    prepare(spark, str(tmp_path), params(max_engines=4), target=str(tmp_path / "out"), as_of=AS_OF)
    engines = read_windows(spark, str(tmp_path / "out")).select("engine_id").distinct().collect()
    assert sorted(r[0][:5] for r in engines) == ["FD001"] * 2 + ["FD002"] * 2


def test_no_engine_long_enough(spark, tmp_path):
    write_fleet(tmp_path / "train_FD001.txt", [5, 6])
    with pytest.raises(ValueError, match="at least 30 cycles"):
        prepare(spark, str(tmp_path), params(), as_of=AS_OF)


def test_writers_that_promote_at_once_get_versions_of_their_own(spark, tmp_path):
    ledgers = [Ledger(spark, str(tmp_path)) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        given = list(pool.map(lambda i: ledgers[i % 4].promote("_a/model", f"run-{i}"), range(12)))
    assert sorted(given) == list(range(1, 13))
    rows = ledgers[0].promotions().collect()
    assert {(r["version"], r["run_id"]) for r in rows} == {(v, f"run-{i}") for i, v in enumerate(given)} and len(rows) == 12
    assert ledgers[1].promote("other", "run-x") == 1
    (tmp_path / "claims" / "model-other" / "2").touch()  # its writer was lost before the row
    assert ledgers[2].promote("other", "run-y") == 3
