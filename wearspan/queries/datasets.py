"""Samples, splits, scaling and the feature build."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from wearspan.functions.digests import seeded_digest
from wearspan.functions.scores import class_name, standardise
from wearspan.functions.times import epoch_micros
from wearspan.operators.linear import LinearModel, fit_centroids, score_stepped
from wearspan.operators.ordinals import digest_rank
from wearspan.operators.ranked import LongSeries
from wearspan.operators.sampling import (
    engine_table,
    select_engines,
    selected_engines,
    split_leaks,
    split_rule,
    split_sizes,
    split_three_ways,
    split_two_ways,
)
from wearspan.operators.scaling import ScalerState, fit_scaler, scale_rows, scale_rows_lazily
from wearspan.operators.windows import sliding_windows, step_column, stepped_windows, window_counts
from wearspan.params import JobParams
from wearspan.plans.features import write_features
from wearspan.queries.catalog import VARYING, query
from wearspan.queries.series import AS_OF, windows_of_30
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.session import scratch_path
from wearspan.sources.bindings import labeled_series, line_plan, table, telemetry, with_copies
from wearspan.sources.tables import read_manifest, read_windows

SAMPLE = 8

_PICKED = """(SELECT dataset_id, global_unit FROM (
    SELECT dataset_id, global_unit, row_number() OVER (PARTITION BY dataset_id ORDER BY md5('42|' || global_unit), global_unit) AS r,
           (SELECT count(*) FROM engines) AS n, (SELECT count(DISTINCT dataset_id) FROM engines) AS k FROM engines)
  WHERE n <= 8 OR r <= greatest(1, 8 // k))"""


@query(
    "dst_1_engine_sample",
    f"""SELECT global_unit, count(*) AS cycles, max(time_in_cycles) AS last_cycle FROM tel
WHERE global_unit IN (SELECT global_unit FROM {_PICKED}) GROUP BY global_unit""",
    ("engines",),
)
def engine_sample(spark, sf_dir):
    """Every row of the picked engines: a semi join, whole series kept (FIL-1, JN-1)."""
    picked = select_engines(telemetry(spark, sf_dir), SAMPLE, 42)
    return picked.groupBy(ENTITY).agg(
        F.count(F.lit(1)).alias("cycles"), F.max(CYCLE).alias("last_cycle")
    )


@query(
    "fn_11_overshooting_quota",
    """SELECT dataset_id, count(*) AS engines FROM (
  SELECT dataset_id, row_number() OVER (PARTITION BY dataset_id ORDER BY md5('7|' || global_unit), global_unit) AS r FROM engines)
WHERE r <= greatest(1, 2 // 4) GROUP BY dataset_id""",
    ("engines",),
)
def overshooting_quota(spark, sf_dir):
    """A limit of 2 over 4 sub-datasets still takes one engine from each."""
    return selected_engines(telemetry(spark, sf_dir), 2, 7).groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("engines")
    )


@query(
    "win_6_seeded_rank",
    """SELECT dataset_id, global_unit, row_number() OVER (PARTITION BY dataset_id ORDER BY md5('42|' || global_unit), global_unit) AS pick
FROM engines""",
    ("engines",),
)
def seeded_rank(spark, sf_dir):
    engines = engine_table(telemetry(spark, sf_dir))
    return digest_rank(engines, seeded_digest(42, F.col(ENTITY)), ENTITY, ["dataset_id"], "pick")


@query("dst_3_three_way_split", "SELECT global_unit, split FROM placed", ("placed",))
def three_way(spark, sf_dir):
    return split_three_ways(telemetry(spark, sf_dir).select(ENTITY))


@query(
    "dst_4_two_way_split",
    """SELECT c_custkey, CASE WHEN r <= CAST(ceil(CAST(0.25 AS DOUBLE) * CAST(n AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'train' END AS split
FROM (SELECT c_custkey, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('7|' || CAST(c_custkey AS VARCHAR)), c_custkey) AS r FROM customer)""",
)
def two_way(spark, sf_dir):
    """Any key column can be split; customers here."""
    return split_two_ways(table(spark, sf_dir, "customer"), 0.25, 7, key="c_custkey")


@query(
    "dst_3_too_few_engines",
    """SELECT split, count(*) AS rows, count(DISTINCT k) AS engines
FROM (SELECT l_linestatus AS k FROM lineitem), (VALUES ('train'), ('val'), ('test')) s(split) GROUP BY split""",
)
def too_few(spark, sf_dir):
    """Two keys only: every split is the full set."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("k"))
    assignment = split_three_ways(rows, key="k")
    return split_sizes(rows.join(assignment, "k"), "k")


@query(
    "set_4_split_leaks",
    """SELECT (SELECT count(*) FROM (SELECT global_unit FROM placed GROUP BY global_unit HAVING count(DISTINCT split) > 1)) AS shared_engines,
       (SELECT count(*) FROM engines WHERE global_unit NOT IN (SELECT global_unit FROM placed)) AS unplaced_engines""",
    ("placed",),
)
def leaks(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    return split_leaks(split_three_ways(rows.select(ENTITY)), rows)


@query(
    "jn_3_split_windows",
    """SELECT split, failure_type, count(*) AS windows, count(DISTINCT engine_id) AS engines
FROM win JOIN placed ON win.engine_id = placed.global_unit GROUP BY split, failure_type""",
    ("win", "placed"),
)
def split_windows(spark, sf_dir):
    windows = windows_of_30(spark, sf_dir).select("engine_id", LABEL)
    assignment = split_three_ways(telemetry(spark, sf_dir).select(ENTITY)).withColumnRenamed(
        ENTITY, "engine_id"
    )
    return windows.join(assignment, "engine_id").groupBy("split", LABEL).agg(
        F.count(F.lit(1)).alias("windows"), F.countDistinct("engine_id").alias("engines")
    )


@query(
    "agg_18_split_sizes",
    """SELECT split, CAST(sum(greatest(0, n - 29)) AS BIGINT) AS windows, count(*) AS engines
FROM (SELECT global_unit, count(*) AS n FROM tel GROUP BY global_unit) c JOIN placed USING (global_unit) GROUP BY split""",
    ("placed",),
)
def sizes(spark, sf_dir):
    """Windows per split from row counts, without building one window."""
    rows = telemetry(spark, sf_dir)
    assignment = split_three_ways(rows.select(ENTITY))
    return window_counts(rows, 30).join(assignment, ENTITY).groupBy("split").agg(
        F.sum("windows").alias("windows"), F.count(F.lit(1)).alias("engines")
    )


_SCALER = "(SELECT " + ", ".join(
    f"sum(w * {c}) / sum(w) AS m{i}, sqrt(greatest(0, sum(w * ({c} - (SELECT sum(w * {c}) / sum(w) FROM weighted)) * ({c} - (SELECT sum(w * {c}) / sum(w) FROM weighted))) / sum(w))) AS s{i}"
    for i, c in enumerate(VARYING)
) + " FROM weighted)"
_TRAIN_ROWS = f"""SELECT {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in VARYING)},
           CASE WHEN n < 30 THEN 0 ELSE least(i, n - 30) - greatest(0, i - 29) + 1 END AS w
    FROM (SELECT *, time_in_cycles - 1 AS i, count(*) OVER (PARTITION BY global_unit) AS n FROM lab) x
    JOIN placed ON x.global_unit = placed.global_unit WHERE split = 'train'"""


def _train_scaler(spark, sf_dir):
    return _train_scaler_and_plan(spark, sf_dir)[::2]


def _train_scaler_and_plan(spark, sf_dir):
    rows, plan = labeled_series(spark, sf_dir)
    train = split_three_ways(rows.select(ENTITY)).filter(F.col("split") == "train")
    return rows, plan, fit_scaler(rows, VARYING, 30, train)


@query(
    "dst_6_scaled_rows",
    f"""SELECT * FROM (WITH weighted AS ({_TRAIN_ROWS})
SELECT global_unit, {', '.join(f'round(sum(CAST(CAST((CAST(CAST({c} AS FLOAT) AS DOUBLE) - m{i}) / CASE WHEN s{i} = 0 THEN 1 ELSE s{i} END AS FLOAT) AS DOUBLE)), 3) AS {c}' for i, c in enumerate(VARYING))}
FROM lab, {_SCALER} GROUP BY global_unit)""",
    ("lab", "placed"),
)
def scaled_rows(spark, sf_dir):
    rows, scaler = _train_scaler(spark, sf_dir)
    scaled = scale_rows(rows, ScalerState.of(scaler))
    return scaled.groupBy(ENTITY).agg(
        *[F.round(F.sum(F.col(c).cast("double")), 3).alias(c) for c in VARYING]
    )


@query(
    "jn_4_scaled_windows",
    f"""SELECT * FROM (WITH weighted AS ({_TRAIN_ROWS})
SELECT engine_id, count(*) AS windows, round(sum(CAST(CAST((CAST(readings[1][1] AS DOUBLE) - m0) / s0 AS FLOAT) AS DOUBLE)), 3) AS oldest,
       round(sum(CAST(CAST((CAST(readings[30][4] AS DOUBLE) - m3) / s3 AS FLOAT) AS DOUBLE)), 3) AS newest
FROM win, {_SCALER} GROUP BY engine_id)""",
    ("win", "placed"),
)
def scaled_windows(spark, sf_dir):
    """Scaler state joined lazily, shape kept, float32 out: windows of scaled rows hold the floats of scaled windows."""
    rows, plan, scaler = _train_scaler_and_plan(spark, sf_dir)
    scaled = sliding_windows(scale_rows_lazily(rows, scaler), 30, VARYING, plan=plan).select(
        "engine_id", F.flatten("readings").alias("windowed_features")
    )
    return scaled.groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.sum(F.element_at("windowed_features", 1).cast("double")), 3).alias("oldest"),
        F.round(F.sum(F.element_at("windowed_features", -1).cast("double")), 3).alias("newest"),
    )


@query(
    "dst_6_scale_then_window",
    "SELECT engine_id, count(*) AS windows, CAST(0 AS BIGINT) AS different FROM win GROUP BY engine_id",
    ("win",),
)
def scale_then_window(spark, sf_dir):
    """Scaling rows before windowing gives the same floats as scaling windows.

    Plain and scaled rows pass through the same windows, so both forms of a window meet without a shuffle of windows.
    """
    rows, plan, scaler = _train_scaler_and_plan(spark, sf_dir)
    state = ScalerState.of(scaler)
    plain = {c: f"plain_{c}" for c in VARYING}
    both = scale_rows(rows.withColumns({p: F.col(c).cast("float") for c, p in plain.items()}), state)
    windows = stepped_windows(both, 30, [*VARYING, *plain.values()], plan=plan)
    differences = [
        ~F.col(step_column(i, c)).eqNullSafe(
            standardise(F.col(step_column(i, plain[c])).cast("double"), F.lit(m), F.lit(s)).cast("float")
        )
        for i in range(30)
        for c, m, s in zip(state.features, state.means, state.stds, strict=True)
    ]
    compared = windows.select("engine_id", reduce(or_, differences).cast("long").alias("different"))
    return compared.groupBy("engine_id").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("different").alias("different")
    )


def built(spark, sf_dir) -> str:
    """Run the whole feature build over telemetry with injected copies; returns its folder."""
    target = scratch_path(spark, "features")
    lines = line_plan(spark, sf_dir)
    raw = with_copies(telemetry(spark, sf_dir, ("l_orderkey",), lines))
    # Without a long supplier there is no long engine, and the numbering has dealt the rows out by engine.
    write_features(raw, target, JobParams(), as_of=AS_OF, long=LongSeries(None) if lines else None)
    return target


_BUILT = """SELECT global_unit AS engine_id, failure_type, count(*) AS windows, CAST(count(*) * 210 AS BIGINT) AS floats,
       CAST(sum(CAST(round(sensor_2 * 100) AS BIGINT)) AS BIGINT) AS newest,
       epoch_us(TIMESTAMP '2024-05-31 01:00:00') + 10000000 * min(global_index) AS first_event
FROM (SELECT *, row_number() OVER (ORDER BY global_unit, position) - 1 AS global_index FROM numbered WHERE position >= 30)
GROUP BY global_unit, failure_type"""


@query("dst_7_feature_build", _BUILT, ("numbered",))
def feature_build(spark, sf_dir):
    """Contract, labels, dedup, flat sensors, windows, contract, write and read back (SRC-4, SRC-6)."""
    rows = read_windows(spark, built(spark, sf_dir))
    newest = F.round(F.element_at("windowed_features", -3).cast("double") * 100).cast("long")
    return rows.groupBy("engine_id", LABEL).agg(
        F.count(F.lit(1)).alias("windows"),
        F.sum(F.size("windowed_features")).alias("floats"),
        F.sum(newest).alias("newest"),
        F.min(epoch_micros("event_timestamp")).alias("first_event"),
    )


@query(
    "src_5_manifest",
    """SELECT CAST(p AS INTEGER) AS position, f AS feature FROM (VALUES (0, 'op_setting_1'), (1, 'op_setting_2'), (2, 'op_setting_3'),
  (3, 'sensor_1'), (4, 'sensor_2'), (5, 'sensor_3'), (6, 'sensor_4')) v(p, f) WHERE EXISTS (SELECT 1 FROM lineitem)""",
)
def built_manifest(spark, sf_dir):
    return read_manifest(spark, built(spark, sf_dir))


def _list(prefix: str) -> str:
    return "[" + ", ".join(f"{prefix}{i}" for i in range(len(VARYING))) + "]"


_SCALED = f"""z AS (SELECT engine_id, failure_type, split, list_transform(flatten(readings), lambda x, i:
         CAST(CAST((CAST(x AS DOUBLE) - ms[(i - 1) % 4 + 1]) / CASE WHEN ss[(i - 1) % 4 + 1] = 0 THEN 1 ELSE ss[(i - 1) % 4 + 1] END AS FLOAT) AS DOUBLE)) AS v
       FROM win JOIN placed ON engine_id = global_unit, (SELECT {_list('m')} AS ms, {_list('s')} AS ss FROM {_SCALER}))"""
_MEANS = """mean AS (SELECT failure_type AS k, list(m ORDER BY i) AS w FROM (
    SELECT failure_type, i, avg(x) AS m FROM (SELECT failure_type, unnest(v) AS x, unnest(generate_series(1, 120)) AS i FROM z WHERE split = 'train')
    GROUP BY failure_type, i) GROUP BY failure_type)"""
_CENTROIDS = f"WITH weighted AS ({_TRAIN_ROWS}), {_SCALED}, {_MEANS}"


def _centroid_model(spark, sf_dir):
    """Scaled rows, their plan and the model; rows are scaled before they are cut into windows, once and not 30 times."""
    rows, plan, scaler = _train_scaler_and_plan(spark, sf_dir)
    scaled = scale_rows(rows, ScalerState.of(scaler))
    train = split_rule(rows.select(ENTITY)).part(scaled, ENTITY, "train")
    windows = sliding_windows(train, 30, VARYING, plan=plan)
    return scaled, plan, fit_centroids(windows.select(LABEL, F.flatten("readings").alias("windowed_features")), None)


@query(
    "trn_1_class_means",
    f"""SELECT * FROM ({_CENTROIDS}
SELECT k AS class, round(-list_dot_product(w, w) / 240, 6) AS intercept, CAST(i AS INTEGER) AS position, round(120 * (w[i] / 120), 6) AS mean
FROM mean, (SELECT unnest(generate_series(1, 120)) AS i))""",
    ("win", "placed"),
)
def class_means(spark, sf_dir):
    """The model of the nearest class mean, as its table: every weight, fitted on the training engines only."""
    table_of_model = _centroid_model(spark, sf_dir)[2].table(spark)
    long = table_of_model.select("class", F.round("intercept", 6).alias("intercept"), F.posexplode("weights").alias("_i", "_w"))
    return long.select("class", "intercept", (F.col("_i") + 1).alias("position"), F.round(F.col("_w") * 120, 6).alias("mean"))


@query(
    "scr_1_table_model",
    f"""SELECT * FROM ({_CENTROIDS},
  score AS (SELECT engine_id, split, failure_type, [a, b, c] AS s, greatest(a, b, c) AS top FROM (
    SELECT engine_id, split, failure_type, {', '.join(f"(list_dot_product(v, w{k}) - list_dot_product(w{k}, w{k}) / 2) / 120 AS {n}" for k, n in enumerate('abc'))}
    FROM z, (SELECT {', '.join(f'any_value(w) FILTER (WHERE k = {k}) AS w{k}' for k in range(3))} FROM mean))),
  chance AS (SELECT *, list_transform(s, lambda x: exp(x - top)) AS e FROM score)
SELECT engine_id, split, failure_type, CASE WHEN s[1] = top THEN 'Healthy' WHEN s[2] = top THEN 'Alert' ELSE 'Critical' END AS prediction,
       count(*) AS windows, round(avg(e[1] / list_sum(e)), 6) AS healthy, round(avg(e[3] / list_sum(e)), 6) AS critical
FROM chance GROUP BY ALL)""",
    ("win", "placed"),
)
def table_model(spark, sf_dir):
    """Every window scored by an expression over a model table, per engine, truth and answer."""
    scaled, plan, model = _centroid_model(spark, sf_dir)
    windows = stepped_windows(scaled, 30, VARYING, plan=plan)
    scored = score_stepped(windows, LinearModel.of(model.table(spark)), VARYING, 30)
    rule = split_rule(telemetry(spark, sf_dir).select(ENTITY))
    placed = rule.assigned(scored, "engine_id")
    return placed.groupBy("engine_id", "split", LABEL, class_name(F.col("predicted")).alias("prediction")).agg(
        F.count(F.lit(1)).alias("windows"),
        F.round(F.avg(F.get("probabilities", 0)), 6).alias("healthy"),
        F.round(F.avg(F.get("probabilities", 2)), 6).alias("critical"),
    )
