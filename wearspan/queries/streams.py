"""Streams run to completion over the given tables; each must equal its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.operators.scaling import ScalerState
from wearspan.operators.training import fit_candidate
from wearspan.queries.catalog import query
from wearspan.schemas import CORRUPT_COLUMN, CYCLE, ENTITY
from wearspan.session import scratch_path
from wearspan.sources import derived
from wearspan.sources.bindings import event_telemetry, table
from wearspan.sources.ledger import Champion, NoChampion
from wearspan.sources.requests import request_json, stream_requests
from wearspan.streaming.live_windows import STATE_STORE, drain, live_windows, start_distinct
from wearspan.streaming.requests import BatchChampion, start_quarantine, start_scoring

WINDOW = 10


def event_stream(spark, sf_dir):
    """`events` read as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


@query(
    "str_4_live_windows",
    """SELECT global_unit, end_cycle, late, CAST(sum_1 AS BIGINT) AS sum_1, CAST(sum_2 AS BIGINT) AS sum_2 FROM (
  SELECT global_unit, time_in_cycles AS end_cycle, false AS late, count(*) OVER w AS n,
         sum(CAST(round(CAST(CAST(sensor_1 AS FLOAT) AS DOUBLE) * 100) AS BIGINT)) OVER w AS sum_1, sum(CAST(sensor_2 AS BIGINT)) OVER w AS sum_2
  FROM feed WINDOW w AS (PARTITION BY global_unit ORDER BY time_in_cycles ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE n = 10""",
    ("feed",),
)
def live(spark, sf_dir):
    """Last ten events of each user, held in keyed state."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        windows = drain(
            live_windows(
                event_telemetry(event_stream(spark, sf_dir)), WINDOW, ["sensor_1", "sensor_2"]
            ),
            scratch_path(spark, "live"),
            scratch_path(spark, "live-state"),
        )
    finally:
        spark.conf.set(provider, before)

    def total(position, scale):
        picked = F.filter("windowed_features", lambda _x, i: i % 2 == position)
        return F.aggregate(
            picked,
            F.lit(0).cast("long"),
            lambda acc, x: acc + F.round(x.cast("double") * scale).cast("long"),
        )

    return windows.select(
        ENTITY, "end_cycle", "late", total(0, 100).alias("sum_1"), total(1, 1).alias("sum_2")
    )


def distinct_feed(spark, sf_dir, lateness: str) -> str:
    """`events` in three micro-batches: all of them, every third one again, and every fiftieth changed.

    The folder grows between runs of one query over one checkpoint, so each part is one batch.
    """
    events = table(spark, sf_dir, "events")
    parts = [events, events.where("event_id % 3 = 0"), events.where("event_id % 50 = 0").withColumn("value", F.col("value") + 1)]
    source, out, state = (scratch_path(spark, f"distinct-{n}") for n in ("in", "out", "state"))
    for part in parts:
        part.write.mode("append").parquet(source)
        feed = spark.readStream.schema(events.schema).parquet(source)
        start_distinct(feed, out, "ts", lateness, state).awaitTermination()
    return out


@query(
    "str_5_live_distinct",
    """SELECT 'U_' || user_id AS global_unit, count(*) AS readings, CAST(sum(epoch_us(ts)) AS BIGINT) AS checksum FROM (
  SELECT user_id, ts FROM events UNION ALL SELECT user_id, ts FROM events WHERE event_id % 50 = 0)
GROUP BY global_unit""",
)
def distinct_readings(spark, sf_dir):
    """With a long delay nothing is late: copies go, changed rows stay."""
    kept = spark.read.parquet(distinct_feed(spark, sf_dir, "3650 DAYS") + "/kept")
    return event_telemetry(kept).groupBy(ENTITY).agg(
        F.count(F.lit(1)).alias("readings"), F.sum(CYCLE).alias("checksum")
    )


_LATE_BORDER = "(SELECT max(ts) - INTERVAL 5 DAY FROM events)"


@query(
    "str_5_late_events",
    f"""SELECT event_id, value, count(*) AS copies FROM (
  SELECT event_id, value, ts FROM events WHERE event_id % 3 = 0 UNION ALL SELECT event_id, value + 1, ts FROM events WHERE event_id % 50 = 0)
WHERE ts < {_LATE_BORDER} GROUP BY event_id, value""",
)
def late_events(spark, sf_dir):
    """Rows behind the border come back whole, copies and changed rows alike."""
    late = spark.read.parquet(distinct_feed(spark, sf_dir, "5 DAYS") + "/late")
    return late.groupBy("event_id", "value").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "str_5_outcomes",
    f"""SELECT count(*) + count_if(event_id % 3 = 0) + count_if(event_id % 50 = 0) AS received,
  count(*) + count_if(event_id % 50 = 0 AND ts >= {_LATE_BORDER}) AS kept, count_if(event_id % 3 = 0 AND ts >= {_LATE_BORDER}) AS duplicates,
  count_if(event_id % 3 = 0 AND ts < {_LATE_BORDER}) + count_if(event_id % 50 = 0 AND ts < {_LATE_BORDER}) AS late FROM events""",
)
def distinct_outcomes(spark, sf_dir):
    """Received = kept + duplicates + late, over all batches."""
    counts = spark.read.parquet(distinct_feed(spark, sf_dir, "5 DAYS") + "/counts")
    return counts.agg(*[F.sum(c).alias(c) for c in ("received", "kept", "duplicates", "late")])


def request_folder(spark, sf_dir) -> str:
    """The derived requests as JSON files; NaN has no JSON form and arrives as text."""
    rows = derived.requests(spark, sf_dir)
    path = scratch_path(spark, "request-files")
    rows.select(request_json(F.col("engine_id"), F.col("readings")).alias("value")).write.text(path)
    return path


@query(
    "str_1_stream_quarantine",
    """SELECT reasons, count(*) AS requests FROM (
  SELECT array_to_string(list_filter([CASE WHEN length(engine_id) > 64 THEN 'engine_id:length' END, CASE WHEN trim(engine_id) = '' THEN 'engine_id:not_blank' END,
      CASE WHEN vec_id % 23 = 0 OR vec_id % 7 = 0 THEN 'readings:rectangular' END,
      CASE WHEN vec_id % 11 = 0 AND vec_id % 23 <> 0 THEN 'readings:finite' END], lambda x: x IS NOT NULL), ',') AS reasons FROM requests)
GROUP BY reasons""",
    ("requests",),
)
def stream_quarantine(spark, sf_dir):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    query_ = start_quarantine(
        stream_requests(spark, request_folder(spark, sf_dir)),
        good,
        bad,
        scratch_path(spark, "quarantine-state"),
    )
    query_.awaitTermination()
    accepted = spark.read.parquet(good).select(F.lit("").alias("reasons"))
    rejected = spark.read.parquet(bad).select("reasons")
    return accepted.unionByName(rejected).groupBy("reasons").agg(
        F.count(F.lit(1)).alias("requests")
    )


def fitted_champion(spark, sf_dir) -> Champion:
    """A model of the embeddings' label modulo three over their 64 values."""
    rows = table(spark, sf_dir, "embeddings").select(
        (F.col("label") % 3).cast("int").alias("failure_type"),
        F.col("embedding").alias("windowed_features"),
    )
    features = tuple(f"signal_{i}" for i in range(8))
    state = ScalerState(features, (0.0,) * 8, (1.0,) * 8)
    model = fit_candidate(rows, state, {0: 1.0, 1: 1.0, 2: 1.0}, 0.01, 10)
    return Champion("embedding_model", "1", "run-1", model, state, 8)


@query(
    "str_1_malformed_texts",
    """SELECT '{"engine_id": "' || vec_id || '", "readings": [[1.0' AS text, 'well_formed' AS reasons, count(*) AS requests
FROM embeddings WHERE vec_id % 29 = 0 GROUP BY vec_id""",
)
def malformed_texts(spark, sf_dir):
    """Cut lines among good ones reach the quarantine with their whole text."""
    folder, bad = request_folder(spark, sf_dir), scratch_path(spark, "bad")
    cut = F.format_string('{"engine_id": "%d", "readings": [[1.0', "vec_id")
    table(spark, sf_dir, "embeddings").where("vec_id % 29 = 0").select(cut.alias("value")).write.mode("append").text(folder)
    start_quarantine(
        stream_requests(spark, folder), scratch_path(spark, "good"), bad, scratch_path(spark, "malformed-state")
    ).awaitTermination()
    refused = spark.read.parquet(bad).where(F.col(CORRUPT_COLUMN).isNotNull())
    return refused.groupBy(F.col(CORRUPT_COLUMN).alias("text"), "reasons").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "str_2_stream_scoring",
    """SELECT model_version, count(*) AS answered FROM (SELECT '1' AS model_version FROM requests
  WHERE vec_id % 23 <> 0 AND vec_id % 7 <> 0 AND vec_id % 11 <> 0 AND trim(engine_id) <> '' AND length(engine_id) <= 64) GROUP BY model_version""",
    ("requests",),
)
def stream_scoring(spark, sf_dir):
    """Good requests answered, none pending, once a champion exists (STR-3 holds it)."""
    champion = fitted_champion(spark, sf_dir)
    champions = BatchChampion(look_up=lambda: champion)
    answers = scratch_path(spark, "stream-answers")
    query_ = start_scoring(
        stream_requests(spark, request_folder(spark, sf_dir)),
        champions,
        answers,
        scratch_path(spark, "stream-refused"),
        scratch_path(spark, "stream-pending"),
        scratch_path(spark, "scoring-state"),
    )
    query_.awaitTermination()
    return spark.read.parquet(answers).groupBy("model_version").agg(
        F.count(F.lit(1)).alias("answered")
    )


@query(
    "scr_4_waiting_requests",
    """SELECT engine_id, count(*) AS waiting, CAST(sum(CASE WHEN vec_id % 23 = 0 THEN 0 ELSE 8 END) AS BIGINT) AS steps
FROM requests GROUP BY engine_id""",
    ("requests",),
)
def waiting_requests(spark, sf_dir):
    """Without a champion nothing is answered or refused: all requests wait, broken ones too."""

    def none_yet():
        raise NoChampion("nothing was promoted")

    pending = scratch_path(spark, "stream-waiting")
    query_ = start_scoring(
        stream_requests(spark, request_folder(spark, sf_dir)),
        BatchChampion(look_up=none_yet),
        scratch_path(spark, "waiting-answers"),
        scratch_path(spark, "waiting-refused"),
        pending,
        scratch_path(spark, "waiting-state"),
    )
    query_.awaitTermination()
    return spark.read.parquet(pending).groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("waiting"), F.sum(F.size("readings")).alias("steps")
    )
