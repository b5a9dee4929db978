from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from helpers import brute_windows
from pyspark.sql import functions as F

from wearspan.operators.scoring import checked_requests
from wearspan.plans.score import score_requests
from wearspan.queries.streams import fitted_champion
from wearspan.sources.ledger import Champion, NoChampion
from wearspan.sources.requests import read_requests, stream_requests
from wearspan.streaming.live_windows import STATE_STORE, drain, late_rows, live_windows, start_distinct
from wearspan.streaming.requests import BatchChampion, DecisionLog, start_quarantine, start_scoring

FEED = "global_unit string, time_in_cycles long, sensor_1 double, sensor_2 double"


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STATE_STORE)
    yield
    spark.conf.set(key, before)


def batches(spark, folder, parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(str(folder / f"p{i:02d}"))
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))


def ordered_batches(spark, folder, parts):
    """One file per micro-batch, taken in the order given."""
    import os
    import time

    stream = batches(spark, folder, parts)
    now = time.time() - 1000
    for i in range(len(parts)):
        for name in (folder / f"p{i:02d}").iterdir():
            os.utime(name, (now + i, now + i))
    return stream


def test_live_windows_equal_batch_windows(spark, rocksdb, tmp_path):
    rng = random.Random(1)
    series = {u: [(u, c, float(rng.randint(0, 99)), float(c)) for c in range(1, n)] for u, n in [("a", 40), ("b", 7), ("c", 3)]}
    parts = []
    for start in range(1, 41, 6):
        chunk = [r for rows in series.values() for r in rows if start <= r[1] < start + 6]
        rng.shuffle(chunk)
        parts.append(chunk)
    stream = live_windows(ordered_batches(spark, tmp_path / "in", parts), 5, ["sensor_1", "sensor_2"])
    got = drain(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    assert got.filter("late").count() == 0
    found = sorted((r["global_unit"], r["end_cycle"], 0, tuple(r["windowed_features"])) for r in got.collect())
    rows = [(1, c, u, x, y, 0) for s in series.values() for u, c, x, y in s]
    assert found == brute_windows(rows, 5)


def test_late_rows_are_set_aside(spark, rocksdb, tmp_path):
    parts = [[("a", c, float(c), 0.0) for c in (1, 2, 3)], [("a", 2, 9.0, 0.0), ("a", 4, 4.0, 0.0)]]
    stream = live_windows(ordered_batches(spark, tmp_path / "in", parts), 3, ["sensor_1"])
    got = drain(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    late = late_rows(got).collect()
    assert [(r["end_cycle"], r["windowed_features"]) for r in late] == [(2, [9.0])]
    kept = {r["end_cycle"]: r["windowed_features"] for r in got.filter("NOT late").collect()}
    assert kept == {3: [1.0, 2.0, 3.0], 4: [2.0, 3.0, 4.0]}


def test_no_row_of_many_batches_is_lost(spark, tmp_path):
    """Copies, changed rows and stragglers in shuffled batches: received = kept + duplicates + late."""
    rng = random.Random(4)
    schema = "id long, at timestamp, v double"
    base = spark.range(60).selectExpr("id", "timestamp_seconds(1700000000 + id * 60) AS at", "cast(id AS double) AS v")
    rows = [tuple(r) for r in base.collect()]
    parts = [rows[i : i + 15] + rng.sample(rows[: i + 15], 5) for i in range(0, 60, 15)]
    parts += [[rows[0], (rows[1][0], rows[1][1], 99.0)], [rows[59], rows[59], (59, rows[59][1], -1.0), (7, None, None)]]
    sent = [r for part in parts for r in part]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        start_distinct(feed, str(tmp_path / "out"), "at", "20 MINUTES", str(tmp_path / "state")).awaitTermination()
    kept = [tuple(r)[:3] for r in spark.read.parquet(str(tmp_path / "out/kept")).select("id", "at", "v").collect()]
    late = [tuple(r)[:3] for r in spark.read.parquet(str(tmp_path / "out/late")).select("id", "at", "v").collect()]
    counts = spark.read.parquet(str(tmp_path / "out/counts")).selectExpr("sum(received)", "sum(kept)", "sum(duplicates)", "sum(late)").first()
    assert len(kept) == len(set(kept)) == counts[1] and set(rows) <= set(kept)
    assert counts[0] == len(sent) == counts[1] + counts[2] + counts[3] and len(late) == counts[3] > 0
    assert set(kept) | set(late) == set(sent)
    assert (7, None, None) in kept and (59, rows[59][1], -1.0) in kept and (1, rows[1][1], 99.0) in late


def test_rows_a_microsecond_apart_are_both_kept(spark, tmp_path):
    schema = "at timestamp, plain timestamp_ntz, inner struct<seen:array<timestamp>>"
    values = [("123456", "5", "5"), ("123457", "5", "5"), ("5", "123456", "5"), ("5", "123457", "5"), ("5", "5", "123456"), ("5", "5", "123457")]
    lines = [f"TIMESTAMP'2024-01-01 00:00:00.{a}' AS at, TIMESTAMP_NTZ'2024-01-01 00:00:00.{b}' AS plain, named_struct('seen', array(TIMESTAMP'2024-01-01 00:00:00.{c}')) AS inner" for a, b, c in values]
    rows = spark.sql(" UNION ALL ".join(f"SELECT {line}" for line in [*lines, lines[0]]))
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        start_distinct(feed, str(tmp_path / "out"), "at", "20 MINUTES", str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/kept")).select("at", "plain", "inner").distinct().count() == len(values)
    counts = spark.read.parquet(str(tmp_path / "out/counts")).selectExpr("sum(received)", "sum(kept)", "sum(duplicates)").first()
    assert tuple(counts) == (14, 6, 8)


def request_files(folder):
    folder.mkdir()
    good = [[float(i + j) for j in range(8)] for i in range(8)]
    rows = [{"engine_id": f"e{i}", "readings": good} for i in range(10)]
    rows += [{"engine_id": " ", "readings": good}, {"engine_id": "short", "readings": good[:3]}]
    lines = [json.dumps(r) for r in rows] + ['{"engine_id": "cut", "readings": [[1.0']
    for i, line in enumerate(lines):
        (folder / f"{i:02d}.json").write_text(line + "\n")
    return str(folder)


def test_a_batch_costs_what_is_held_and_not_what_was(spark, tmp_path):
    """Each of 16 batches has ten new minutes and repeats the ten before; a row of long ago is late, one without time is known."""
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "at timestamp, value int"
    sizes = []
    for hour in range(16):
        start = datetime(2024, 1, 1) + timedelta(hours=hour)
        minutes = range(-60, 10) if hour else range(10)
        rows = [(start + timedelta(minutes=m), 1) for m in minutes if m % 60 < 10] + [(None, 7)]
        rows += [(datetime(2024, 1, 1), 1)] if hour > 3 else []
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        start_distinct(spark.readStream.schema(schema).parquet(source), out, "at", "2 HOURS", state).awaitTermination()
        sizes.append(len(list((tmp_path / "out" / "seen" / "digests").glob("bucket=*/batch=*/*.parquet"))))
    kept = spark.read.schema(schema).parquet(f"{out}/kept")
    assert kept.count() == kept.distinct().count() == 161
    assert spark.read.schema(schema).parquet(f"{out}/late").count() == 12
    assert max(sizes) <= 6 and sizes[-1] <= sizes[5]


def test_a_replayed_batch_finds_the_digests_it_had(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    schema = "at timestamp, value int"

    def run():
        start_distinct(spark.readStream.schema(schema).parquet(source), out, "at", "1 HOUR", state).awaitTermination()

    for hour in range(5):
        rows = [(datetime(2024, 1, 1) + timedelta(hours=h, minutes=m), 1) for h in (hour - 1, hour) for m in (0, 20, 40)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    before = {name: sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) for name in ("kept", "late", "counts")}
    for folder in ("commits", "offsets"):
        assert (tmp_path / "state" / folder / "4").exists()
    (tmp_path / "state" / "commits" / "4").unlink()
    (tmp_path / "state" / "commits" / ".4.crc").unlink(missing_ok=True)
    run()
    assert {name: sorted(map(str, spark.read.parquet(f"{out}/{name}").collect())) for name in before} == before


def test_stream_quarantine_equals_batch(spark, tmp_path):
    path = request_files(tmp_path / "in")
    start_quarantine(
        stream_requests(spark, path, 4), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "state")
    ).awaitTermination()
    checked = checked_requests(read_requests(spark, path))
    assert spark.read.parquet(str(tmp_path / "good")).count() == checked.good().count() == 11
    assert spark.read.parquet(str(tmp_path / "bad")).count() == checked.bad().count() == 2


def test_stream_scoring_equals_batch(spark, tmp_path, small_dir):
    path = request_files(tmp_path / "in")
    champion = fitted_champion(spark, small_dir)
    start_scoring(
        stream_requests(spark, path, 5),
        BatchChampion(lambda: champion),
        str(tmp_path / "answers"),
        str(tmp_path / "refused"),
        str(tmp_path / "pending"),
        str(tmp_path / "state"),
    ).awaitTermination()
    keys = ["engine_id", "prediction", F.map_values("probabilities").alias("p")]
    batch = score_requests(read_requests(spark, path), champion)
    streamed = spark.read.parquet(str(tmp_path / "answers"))
    assert sorted(map(str, streamed.select(keys).collect())) == sorted(map(str, batch.answers.select(keys).collect()))
    assert spark.read.parquet(str(tmp_path / "refused")).count() == batch.rejected.count() == 3
    assert not (tmp_path / "pending").exists()


def test_requests_wait_without_a_champion(spark, tmp_path):
    path = request_files(tmp_path / "in")

    def nothing():
        raise RuntimeError("no champion yet")

    start_scoring(
        stream_requests(spark, path), BatchChampion(nothing), str(tmp_path / "a"), str(tmp_path / "r"), str(tmp_path / "p"), str(tmp_path / "s")
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "p")).count() == 13
    assert not (tmp_path / "a").exists()


def test_malformed_text_survives_every_sink(spark, tmp_path, small_dir):
    path = request_files(tmp_path / "in")
    cut = '{"engine_id": "cut", "readings": [[1.0'
    start_quarantine(stream_requests(spark, path), str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "s1")).awaitTermination()
    bad = spark.read.parquet(str(tmp_path / "bad")).where("_corrupt_record IS NOT NULL").collect()
    assert [(r["_corrupt_record"], r["reasons"]) for r in bad] == [(cut, "well_formed")]
    refused = score_requests(read_requests(spark, path), fitted_champion(spark, small_dir)).rejected
    assert [r["reasons"] for r in refused.where("_corrupt_record IS NOT NULL").collect()] == ["well_formed"]

    def nothing():
        raise RuntimeError("none")

    start_scoring(stream_requests(spark, path), BatchChampion(nothing), str(tmp_path / "a"), str(tmp_path / "r"), str(tmp_path / "p"), str(tmp_path / "s2")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "p")).where(F.col("_corrupt_record") == cut).count() == 1


def test_batches_without_champion_ask_again(spark):
    answers = iter([RuntimeError("down"), "v1", "v2"])
    now = [0.0]

    def look_up():
        answer = next(answers)
        if isinstance(answer, Exception):
            raise answer
        return answer

    champions = BatchChampion(look_up, every_seconds=5, clock=lambda: now[0])
    assert [champions.of(0), champions.of(0), champions.of(1)] == [None, None, None]
    now[0] = 6.0
    assert champions.of(1) is None  # a replay keeps its decision
    assert [champions.of(2), champions.of(3)] == ["v1", "v1"]
    now[0] = 60.0
    assert champions.of(4) == "v1"
    assert next(answers) == "v2"


def test_followed_promotions_change_at_a_border(spark):
    now, versions = [0.0], iter("xyz")
    champions = BatchChampion(lambda: next(versions), 10, follow_promotions=True, clock=lambda: now[0])
    assert [champions.of(i) for i in (0, 1)] == ["x", "x"]
    now[0] = 12.0
    assert [champions.of(i) for i in (1, 2, 2, 3)] == ["x", "y", "y", "y"]


def test_a_restarted_stream_gives_a_replayed_batch_the_version_it_had(spark, tmp_path):
    log = DecisionLog(spark, str(tmp_path / "decisions"))

    def version(name, number, run_id):
        return Champion(name, number, run_id, None, None, 30)

    def started(look_up):
        return BatchChampion(look_up, follow_promotions=True, every_seconds=0.0, log=log, recall=version)

    def none_yet():
        raise NoChampion

    first, second = version("m", "1", "r1"), version("m", "2", "r2")
    before = started(none_yet)
    assert before.of(0) is None
    before.look_up = lambda: first
    assert before.of(1) == first
    (tmp_path / "decisions" / "batch=2").mkdir()  # the write was cut short
    after = started(lambda: second)
    assert [after.of(batch) for batch in (0, 1, 2)] == [None, first, second]
    assert started(none_yet).of(2) == second
    with pytest.raises(ValueError, match="recall"):
        BatchChampion(none_yet, log=log)
    lost = BatchChampion(none_yet, log=log, recall=lambda *_: none_yet())
    with pytest.raises(NoChampion):
        lost.of(1)
