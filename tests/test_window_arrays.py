"""Window tables scaled and digested batch by batch, against the forms that walk every window."""

from __future__ import annotations

import numpy as np
from helpers import CLEAN, uneven_series
from pyspark.sql import functions as F

from wearspan.operators.lineage import _limb_sums, digests_of_series, digests_of_windows
from wearspan.operators.scaling import ScalerState, scale_flat, scale_window_table
from wearspan.operators.windows import indexed_windows

STATE = ScalerState(("a", "b"), (0.1, 7.0), (0.3, 0.0))


def test_scaled_tables_hold_the_floats_of_scaled_windows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=n).astype("f4").tolist()) for i, n in enumerate([6] * 50 + [0, 5, 7])]
    rows += [(90, None), (91, [1.0, None, float("nan"), -0.0]), (92, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "i int, flat array<float>").repartition(3)
    walked = df.withColumn("flat", scale_flat(F.col("flat"), STATE))
    batched = scale_window_table(df, STATE, "flat")
    text = [r.selectExpr("i", "cast(flat as string) flat").collect() for r in (walked, batched)]
    assert sorted(text[0]) == sorted(text[1])


def test_a_changed_value_inside_a_window_changes_its_digest_alone(spark):
    df = spark.createDataFrame([(*r[:5], int(r[4] * 3)) for r in uneven_series()], CLEAN)
    table = indexed_windows(df, 7, ["sensor_1", "sensor_2"]).withColumn("windowed_features", F.flatten("readings"))
    hit = (F.col("engine_id") == "hot") & (F.col("window_index") == 50)
    value = F.transform("windowed_features", lambda x, i: F.when(hit & (i == 5), x + 1).otherwise(x))
    plain = digests_of_windows(table, 2)
    changed = digests_of_windows(table.withColumn("windowed_features", value), 2)
    assert [(r[0], r[1]) for r in changed.exceptAll(plain).collect()] == [("hot", 50)]
    shuffled = digests_of_windows(table.repartition(5, F.rand(3)), 2)
    assert shuffled.exceptAll(plain).count() == 0
    assert plain.count() == digests_of_series(df, ["sensor_1", "sensor_2"], 7).count()


def test_a_row_is_digested_once_where_windows_lie_in_order(monkeypatch):
    calls = []
    import wearspan.operators.lineage as lineage

    real = lineage.hashlib.sha256
    monkeypatch.setattr(lineage.hashlib, "sha256", lambda x: calls.append(x) or real(x))
    bits = np.arange(100)[:, None, None] + np.arange(30)[None, :, None] + np.zeros((1, 1, 2), dtype=np.int64)
    _limb_sums(["e"] * 100, list(range(100)), bits)
    assert len(calls) == 129


def test_the_text_source_reads_each_part_once(spark, small_dir):
    from wearspan.queries.sources import text_files

    folder = text_files(spark, small_dir)
    lines = spark.read.text(f"{folder}/train_FD00*.txt")
    assert lines.count() == spark.read.parquet(f"{small_dir}/lineitem.parquet").count()


def test_lines_are_trimmed_as_by_a_regular_expression(spark):
    from wearspan.sources.text import tokens

    texts = ["", " ", "\t\x0b 1 2\f\r", "1  2\t3", "\u00a01 2\u00a0", " a", "a "]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    plain = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")
    assert df.filter(~tokens(F.col("value")).eqNullSafe(plain)).count() == 0
    assert "regexp_replace" not in df.select(tokens(F.col("value")))._jdf.queryExecution().executedPlan().toString()
