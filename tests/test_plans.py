"""The shape of physical plans: what is shuffled, and what never happens."""

from __future__ import annotations

from helpers import CLEAN, uneven_series
from pyspark.sql import functions as F

from wearspan.operators.blocks import SplitPolicy, plan_blocks
from wearspan.operators.labeling import label_telemetry
from wearspan.operators.scaling import moments_by_weight, weighted_rows
from wearspan.operators.windows import sliding_windows
from wearspan.sources.bindings import labeled_series, table

def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def test_labels_and_windows_share_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(uneven_series(), CLEAN).drop("failure_type")
    rows.write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_blocks(df, "global_unit", "time_in_cycles", halo=29)
    windows = sliding_windows(label_telemetry(df, plan=plan), 30, ["sensor_1", "sensor_2"], plan=plan)
    assert hash_exchanges(physical(windows)) == 1
    assert "SinglePartition" not in physical(windows)


def test_split_series_add_two_broadcasts_and_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(uneven_series(), CLEAN).write.parquet(path)
    df = spark.read.parquet(path)
    plan = plan_blocks(df, "global_unit", "time_in_cycles", halo=4, policy=SplitPolicy(40, 1000, 4))
    text = physical(sliding_windows(df, 5, ["sensor_1"], plan=plan))
    assert hash_exchanges(text) == 1
    assert text.count("BroadcastExchange") == 2


def test_size_check_reads_only_the_entity_column(spark, small_dir):
    rows, _ = labeled_series(spark, small_dir)
    sizes = rows.groupBy("global_unit").agg(F.count(F.lit(1)))
    text = physical(sizes)
    assert "ReadSchema: struct<l_suppkey:bigint>" in text
    assert "Window" not in text


def test_filters_and_columns_reach_the_scan(spark, small_dir):
    picked = table(spark, small_dir, "lineitem").filter("l_suppkey = 3").select("l_discount")
    text = physical(picked)
    assert "EqualTo(l_suppkey,3)" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_discount:double>" in text


def test_scaler_reads_and_shuffles_the_rows_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(uneven_series(), CLEAN).write.parquet(path)
    features = ["sensor_1", "sensor_2"]
    text = physical(moments_by_weight(weighted_rows(spark.read.parquet(path), features, 30), features))
    assert text.count("FileScan") == 1
    assert "Exchange hashpartitioning(global_unit" in text and "Exchange hashpartitioning(_weight" in text
    assert hash_exchanges(text) == 2 and text.count("Sort [") == 1
    assert text.index("partial_avg") > text.index("Exchange hashpartitioning(_weight")


def test_numbering_and_labels_share_one_exchange(spark, small_dir):
    rows, plan = labeled_series(spark, small_dir)
    assert plan.partition_keys == ["global_unit"]
    assert hash_exchanges(physical(rows)) == 1
    assert hash_exchanges(physical(rows.dropDuplicates())) == 1


def test_many_rows_are_dealt_out_once_for_numbering_and_labels(spark, small_dir):
    spark.conf.set("spark.wearspan.rowsPerTask", "500")
    try:
        text = physical(labeled_series(spark, small_dir)[0].dropDuplicates())
    finally:
        spark.conf.unset("spark.wearspan.rowsPerTask")
    lines = table(spark, small_dir, "lineitem").count()
    assert hash_exchanges(text) == 1
    assert "Exchange hashpartitioning(global_unit" in text and f", {-(-lines // 500)}), REPARTITION_BY_NUM" in text
