from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from helpers import one_engine, write_fleet
from pyarrow import parquet
from pyspark.sql import functions as F

from wearspan.operators.contracts import ContractError, check
from wearspan.params import JobParams
from wearspan.plans.features import TEXT_TELEMETRY, write_features
from wearspan.schemas import CORRUPT_COLUMN, LINE_COLUMNS, WINDOW_TABLE
from wearspan.session import attach, scratch_path, shared_dir, written
from wearspan.sources.requests import parse_request, read_requests
from wearspan.sources.tables import (
    check_training_table,
    feature_names,
    read_manifest,
    read_windows,
    write_manifest,
    write_windows,
)
from wearspan.sources.text import extract_units, read_lines, read_telemetry, write_lines

NOW = datetime(2024, 1, 1)
NUMBERS = " ".join(f"{i}.5" for i in range(24))


def test_text_is_split_tagged_and_blank_lines_skipped(spark, tmp_path):
    (tmp_path / "train_FD001.txt").write_text(f"1 1 {NUMBERS}  \n\n   \n  2 7   {NUMBERS}\n")
    (tmp_path / "train_FD003.txt").write_text(f"1 1 {NUMBERS}\n")
    (tmp_path / "test_FD001.txt").write_text("ignored\n")
    rows = read_telemetry(spark, str(tmp_path)).orderBy("global_unit").collect()
    assert [r["global_unit"] for r in rows] == ["FD001_1", "FD001_2", "FD003_1"]
    assert [r["dataset_id"] for r in rows] == ["FD001", "FD001", "FD003"]
    assert rows[1]["time_in_cycles"] == 7
    assert rows[0]["sensor_21"] == 23.5
    assert set(LINE_COLUMNS) <= set(rows[0].asDict())


def test_no_file_names_the_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match=str(tmp_path)):
        read_lines(spark, str(tmp_path))


@pytest.mark.parametrize("line", [f"1 1 {NUMBERS} 9.9", f"1 1 {NUMBERS[:-5]}", f"1 1 word {NUMBERS[4:]}"])
def test_damaged_lines_break_the_contract(spark, tmp_path, line):
    (tmp_path / "train_FD001.txt").write_text(f"1 1 {NUMBERS}\n{line}\n")
    with pytest.raises(ContractError):
        check(read_telemetry(spark, str(tmp_path)), TEXT_TELEMETRY).enforce()


def test_written_lines_read_back(spark, tmp_path):
    write_fleet(tmp_path / "train_FD001.txt", [5, 8])
    rows = read_telemetry(spark, str(tmp_path))
    write_lines(rows, str(tmp_path / "copy" / "train_FD002.txt"))
    again = read_telemetry(spark, str(tmp_path / "copy"))
    columns = list(LINE_COLUMNS)
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(
        map(tuple, rows.select(columns).collect())
    )
    assert {r[0] for r in again.select("dataset_id").collect()} == {"FD002"}


def test_unit_extract_keeps_lines_as_they_are(spark, tmp_path):
    kept = [f"1 1 {NUMBERS}  ", f"  5\t2 {NUMBERS}"]
    (tmp_path / "train_FD001.txt").write_text("\n".join([*kept, "", f"6 1 {NUMBERS}", f"15 1 {NUMBERS}"]) + "\n")
    extract_units(spark, str(tmp_path), str(tmp_path / "toy"), {1, 2, 3, 4, 5})
    got = spark.read.text(str(tmp_path / "toy" / "train_FD001.txt"))
    assert sorted(r[0] for r in got.collect()) == sorted(kept)
    with pytest.raises(RuntimeError, match="units"):
        extract_units(spark, str(tmp_path), str(tmp_path / "none"), {77})


def windows(spark, *rows):
    return spark.createDataFrame([(n, NOW, NOW, v, c) for n, v, c in rows], WINDOW_TABLE)


def test_window_table_and_manifest_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    path = write_windows(windows(spark, ("a", [1.0] * 6, 0), ("b", [2.0] * 6, 2)), folder, 6)
    write_manifest(spark, ["z", "y", "x"], folder, path)
    assert read_windows(spark, folder).count() == 2
    assert feature_names(read_manifest(spark, folder)) == ["z", "y", "x"]
    check_training_table(read_windows(spark, folder), ["z", "y", "x"], 2)


def test_a_broken_table_leaves_the_published_one(spark, tmp_path):
    folder = str(tmp_path)
    write_manifest(spark, ["x"], folder, write_windows(windows(spark, ("a", [1.0] * 6, 0)), folder, 6))
    with pytest.raises(ContractError):
        write_windows(windows(spark, ("b", [1.0] * 5, 0)), folder, 6)
    assert feature_names(read_manifest(spark, folder)) == ["x"]
    assert [r["engine_id"] for r in check_training_table(read_windows(spark, folder), ["x"], 6).collect()] == ["a"]


def test_missing_and_empty_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="feature build"):
        read_windows(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="feature build"):
        read_manifest(spark, str(tmp_path))
    write_manifest(spark, ["x"], str(tmp_path), write_windows(windows(spark), str(tmp_path), 6))
    with pytest.raises(ValueError, match="empty"):
        read_windows(spark, str(tmp_path))


def test_tables_of_other_writers_are_read_as_they_are(spark, tmp_path):
    admitted = spark.createDataFrame([("a", [1.5, 2.5], 1)], "engine_id string, windowed_features array<double>, failure_type bigint")
    admitted.withColumn("event_timestamp", F.current_timestamp()).write.parquet(str(tmp_path / "engine_features.parquet"))
    rows = check_training_table(read_windows(spark, str(tmp_path)), ["x"], 2)
    assert rows.schema.simpleString() == WINDOW_TABLE.simpleString()
    assert [(r["windowed_features"], r["failure_type"], r["created_timestamp"]) for r in rows.collect()] == [([1.5, 2.5], 1, None)]
    with pytest.raises(ContractError, match="type"):
        check_training_table(admitted.withColumn("event_timestamp", F.lit("now")), ["x"], 2)


def test_table_manifest_and_window_must_agree(spark):
    rows = windows(spark, ("a", [1.0] * 6, 0))
    with pytest.raises(ValueError, match="multiple of the window 4"):
        check_training_table(rows, ["x"], 4)
    with pytest.raises(ValueError, match="manifest names 2"):
        check_training_table(rows, ["x", "y"], 2)
    mixed = windows(spark, ("a", [1.0] * 6, 0), ("b", [1.0] * 4, 0))
    with pytest.raises(ContractError, match="windowed_features:length: 1"):
        check_training_table(mixed, ["x", "y", "z"], 2)


def test_malformed_requests_are_kept_whole(spark, tmp_path):
    lines = [
        '{"engine_id": "a", "readings": [[1.0, 2.0]]}',
        '{"engine_id": "a", "readings": "text"}',
        '{"engine_id": "a", "readings": [[1.0',
        '{"engine_id": "b", "readings": [[1.0, 2.0], [3.0]]}',
    ]
    (tmp_path / "r.json").write_text("\n".join(lines))
    rows = read_requests(spark, str(tmp_path)).collect()
    assert sorted(r[CORRUPT_COLUMN] for r in rows if r[CORRUPT_COLUMN]) == sorted(lines[1:3])
    column = spark.createDataFrame([(x,) for x in lines], "t string").select(parse_request(F.col("t")).alias("r"))
    assert column.filter(f"r.{CORRUPT_COLUMN} IS NULL").count() == 2


def test_job_parameters_are_checked():
    assert JobParams.from_mapping({"window_size": 5}).window_size == 5
    for bad in ({"window_size": 0}, {"f2_threshold": 1.5}, {"critical_recall_threshold": -0.1}, {"num_features": 14}, {"model_name": ""}, {"patience": 0}, {"reg_params": ()}):
        with pytest.raises(ValueError):
            JobParams.from_mapping(bad)
    with pytest.raises(TypeError):
        JobParams(window_size="30")


def test_scratch_lies_in_the_session_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()
    table = written(spark.range(5).withColumnRenamed("id", "k"), "t")
    assert attach(spark.range(9).withColumnRenamed("id", "k"), table, "k").count() == 5


def test_requests_keep_the_types_they_were_written_with(spark, tmp_path):
    good = ['{"engine_id": "5", "readings": [[1, 2.5]]}', '  {"readings": [["NaN"]], "engine_id": null}', '{"readings": []}', '{"engine_id": "e"}']
    bad = ['{"engine_id": 5, "readings": []}', '{"engine_id": 5.5}', '{"engine_id": true}', '{"engine_id": ["a"]}', '{"engine_id": {"a": "b"}}', '[{"engine_id": "a"}, {"engine_id": "b"}]']
    bad += ['{"engine_id": "a", "engine_id": "b"}', '{"engine_id": "a", "readings": "none"}', '{"engine_id": "a", "readings": [["1.5"]]}', '"a"', "5", "null", "{", '{"engine_id": "a"} x']
    bad += ['{"engine_id": "a"} {"engine_id": "b"}', '{"engine_id": "a"}, {"engine_id": "b"}', '{"engine_id": "a"}] {}', '{"engine_id": "a"}} {}', '{"engine_id": "a"}, "b": {}']
    (tmp_path / "in.json").write_text("\n".join([*good, "", "   ", *bad]) + "\n")
    rows = read_requests(spark, str(tmp_path / "in.json")).collect()
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None) == sorted(bad)
    kept = [(r["engine_id"], str(r["readings"])) for r in rows if r["_corrupt_record"] is None]
    assert sorted(kept, key=str) == sorted([("5", "[[1.0, 2.5]]"), (None, "[[nan]]"), (None, "[]"), ("e", "None")], key=str)
    held = spark.createDataFrame([(None,), (bad[0],)], "text string").select(parse_request(F.col("text")).alias("r")).collect()
    assert held[0]["r"] is None and held[1]["r"].asDict() == {"engine_id": None, "readings": None, "_corrupt_record": bad[0]}


def test_built_windows_are_written_as_plain_values(spark, tmp_path):
    path = write_features(one_engine(spark), str(tmp_path), JobParams(window_size=2), as_of=NOW)
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == "false"
    values = [
        group.column(i)
        for file in Path(path).glob("*.parquet")
        for meta in [parquet.ParquetFile(file).metadata]
        for group in map(meta.row_group, range(meta.num_row_groups))
        for i in range(group.num_columns)
        if group.column(i).path_in_schema.startswith("windowed_features")
    ]
    assert values and {v.path_in_schema for v in values} == {"windowed_features.array"}
    assert not any("DICTIONARY" in e for v in values for e in v.encodings)
    rows = read_windows(spark, str(tmp_path)).orderBy("event_timestamp").collect()
    steps = [[1.5, -1.5, 75.0, gauge] for gauge in (41.5, 41.75, 43.0, 60.25)]
    assert [r["windowed_features"] for r in rows] == [steps[i] + steps[i + 1] for i in range(3)]


def test_a_feature_outside_the_contract_keeps_its_missing_values(spark, tmp_path):
    raw = one_engine(spark).withColumn("humidity", F.when(F.col("time_in_cycles") != 5, 0.5))
    write_features(raw, str(tmp_path), JobParams(window_size=2), as_of=NOW)
    rows = read_windows(spark, str(tmp_path)).orderBy("event_timestamp").collect()
    position = feature_names(read_manifest(spark, str(tmp_path))).index("humidity")
    assert [r["windowed_features"][position] for r in rows] == [0.5, None, 0.5]
