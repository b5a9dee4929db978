"""Aggregations over telemetry and metric tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.operators.labeling import drop_duplicate_rows, last_cycles, sensor_spread
from wearspan.operators.lineage import DIGEST, contents_of_series, digest_total, fingerprint
from wearspan.operators.metrics import (
    average_f1,
    baseline,
    class_report,
    confusion,
    confusion_cells,
    diagnostics,
    gate_metrics,
    mean_loss,
    weighted_log_loss,
)
from wearspan.operators.ranked import LongSeries
from wearspan.operators.sampling import split_three_ways
from wearspan.operators.scaling import fit_scaler, window_weight
from wearspan.operators.weights import attach_weights, class_weights, majority_class
from wearspan.queries.catalog import (
    ACCURACY,
    MACRO_F1,
    SERIES,
    VARYING,
    by_support,
    f_score,
    precision,
    predicted,
    query,
    recall,
    support,
)
from wearspan.schemas import CYCLE, ENTITY, LABEL
from wearspan.sources import derived
from wearspan.sources.bindings import labeled, labeled_series, numbered_lines, table, telemetry, with_copies

_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE failure_type = {t} AND predicted = {p}) AS t{t}_p{p}"
    for t in range(3)
    for p in range(3)
)
BY_DATASET = f"(SELECT dataset_id, {_COUNTS} FROM judged GROUP BY dataset_id)"


def dataset_confusion(spark, sf_dir):
    return confusion(derived.judged(spark, sf_dir), LABEL, "predicted", ["dataset_id"])


@query(
    "agg_1_last_cycle",
    "SELECT global_unit, max(time_in_cycles) AS max_cycle FROM tel GROUP BY global_unit",
    ("tel",),
)
def last_cycle(spark, sf_dir):
    return last_cycles(telemetry(spark, sf_dir))


@query(
    "agg_2_engine_counts",
    """SELECT coalesce(dataset_id, 'all') AS dataset_id, count(DISTINCT global_unit) AS engines FROM tel GROUP BY dataset_id
UNION ALL SELECT 'all', count(DISTINCT global_unit) FROM tel""",
    ("tel",),
)
def engine_counts(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    each = rows.groupBy("dataset_id").agg(F.countDistinct(ENTITY).alias("engines"))
    return each.unionByName(
        rows.agg(F.countDistinct(ENTITY).alias("engines")).withColumn("dataset_id", F.lit("all"))
    )


@query(
    "agg_3_sensor_spread",
    "SELECT " + ", ".join(f"round(stddev_samp(sensor_{i}), 6) AS sensor_{i}" for i in range(1, 6)) + " FROM clean",
    ("clean",),
)
def spread(spark, sf_dir):
    rows = drop_duplicate_rows(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))
    one = sensor_spread(rows)
    return one.select(*[F.round(c, 6).alias(c) for c in one.columns])


_WEIGHTED = f"""
  SELECT * FROM (
    SELECT {', '.join(f'CAST(CAST({c} AS FLOAT) AS DOUBLE) AS {c}' for c in VARYING)}, lab.global_unit, n,
           CASE WHEN n < 30 THEN 0 ELSE least(i, n - 30) - greatest(0, i - 29) + 1 END AS w
    FROM (SELECT *, row_number() OVER ({SERIES}) - 1 AS i, count(*) OVER (PARTITION BY global_unit) AS n FROM lab) lab
    JOIN placed ON lab.global_unit = placed.global_unit WHERE split = 'train')"""


_MOMENTS = " UNION ALL ".join(
    f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS feature, round(m, 4) AS mean,
       round((SELECT sqrt(sum(w * ({c} - m) * ({c} - m)) / sum(w)) FROM weighted), 4) AS std, n
FROM (SELECT sum(w * {c}) / sum(w) AS m, CAST(sum(w) AS BIGINT) AS n FROM weighted)"""
    for i, c in enumerate(VARYING)
)


@query(
    "agg_4_scaler_state",
    f"SELECT * FROM (WITH weighted AS ({_WEIGHTED}) {_MOMENTS})",
    ("lab", "placed"),
)
def scaler_state(spark, sf_dir):
    rows = labeled(spark, sf_dir)
    train = split_three_ways(rows.select(ENTITY)).filter(F.col("split") == "train")
    state = fit_scaler(rows, VARYING, 30, train)
    return state.withColumn("mean", F.round("mean", 4)).withColumn("std", F.round("std", 4))


@query(
    "agg_4_window_weights",
    """SELECT global_unit, CAST(sum(w) AS BIGINT) AS weight, CAST(max(w) AS BIGINT) AS heaviest FROM (
  SELECT global_unit, CASE WHEN n < 30 THEN 0 ELSE least(i, n - 30) - greatest(0, i - 29) + 1 END AS w
  FROM (SELECT global_unit, time_in_cycles - 1 AS i, count(*) OVER (PARTITION BY global_unit) AS n FROM tel))
GROUP BY global_unit""",
    ("tel",),
)
def window_weights(spark, sf_dir):
    """Weights per engine from the last cycle alone: cycles are dense in this view."""
    rows = labeled(spark, sf_dir)
    size = F.col(CYCLE) + F.col("RUL")
    weight = window_weight(F.col(CYCLE) - 1, size, 30)
    return rows.groupBy(ENTITY).agg(
        F.sum(weight).alias("weight"), F.max(weight).alias("heaviest")
    )


@query(
    "agg_5_class_weights",
    """SELECT d.class, d.name, coalesce(c.n, 0) AS rows, CASE WHEN coalesce(c.n, 0) = 0 THEN CAST(1 AS DOUBLE)
       ELSE round(CAST(t.n AS DOUBLE) / (t.k * c.n), 6) END AS weight
FROM (VALUES (0, 'Healthy'), (1, 'Alert'), (2, 'Critical')) d(class, name)
LEFT JOIN (SELECT failure_type, count(*) AS n FROM lab GROUP BY failure_type) c ON c.failure_type = d.class,
     (SELECT count(*) AS n, count(DISTINCT failure_type) AS k FROM lab) t""",
    ("lab",),
)
def balance(spark, sf_dir):
    return class_weights(labeled(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query(
    "jn_5_weighted_rows",
    """SELECT l.dataset_id, l.failure_type, count(*) AS rows, round(sum(CAST(t.n AS DOUBLE) / (t.k * c.n)), 4) AS total_weight
FROM lab l JOIN (SELECT failure_type, count(*) AS n FROM lab GROUP BY failure_type) c ON c.failure_type = l.failure_type,
     (SELECT count(*) AS n, count(DISTINCT failure_type) AS k FROM lab) t
GROUP BY l.dataset_id, l.failure_type""",
    ("lab",),
)
def weighted_rows(spark, sf_dir):
    rows = labeled(spark, sf_dir)
    return attach_weights(rows, class_weights(rows)).groupBy("dataset_id", LABEL).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("weight"), 4).alias("total_weight")
    )


@query(
    "agg_6_majority_class",
    """SELECT CAST(failure_type AS INTEGER) AS majority_class FROM (SELECT failure_type, count(*) AS n FROM lab GROUP BY failure_type)
ORDER BY n DESC, failure_type LIMIT 1""",
    ("lab",),
)
def majority(spark, sf_dir):
    return majority_class(labeled(spark, sf_dir))


@query(
    "agg_7_confusion",
    """SELECT d.dataset_id, t.t AS truth, p.p AS predicted, count(j.failure_type) AS rows
FROM (SELECT DISTINCT dataset_id FROM tel) d CROSS JOIN (VALUES (0), (1), (2)) t(t) CROSS JOIN (VALUES (0), (1), (2)) p(p)
LEFT JOIN judged j ON j.dataset_id = d.dataset_id AND j.failure_type = t.t AND j.predicted = p.p
GROUP BY ALL""",
    ("judged",),
)
def confusion_matrix(spark, sf_dir):
    return confusion_cells(dataset_confusion(spark, sf_dir), ["dataset_id"])


@query(
    "agg_8_gate_metrics",
    f"""SELECT dataset_id, round({ACCURACY}, 6) AS accuracy, round({by_support(4)}, 6) AS f2_weighted,
       round({recall(2)}, 6) AS critical_recall FROM {BY_DATASET}""",
    ("judged",),
)
def gate(spark, sf_dir):
    """Accuracy, weighted F2 and critical recall per sub-dataset (AGG-8, 9, 10, EVL-1)."""
    metrics = gate_metrics(dataset_confusion(spark, sf_dir), ["dataset_id"])
    return metrics.select(
        "dataset_id",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "f2_weighted", "critical_recall")],
    )


@query(
    "agg_10_absent_critical",
    f"""SELECT round({ACCURACY}, 6) AS accuracy, round({by_support(4)}, 6) AS f2_weighted, round({recall(2)}, 6) AS critical_recall
FROM (SELECT {_COUNTS} FROM (SELECT quality AS failure_type, toxic AS predicted FROM labels))""",
)
def absent_critical(spark, sf_dir):
    """A table with two classes only: recall of the absent one is zero, not an error."""
    counts = confusion(table(spark, sf_dir, "labels"), "quality", "toxic")
    return gate_metrics(counts).select(
        *[F.round(c, 6).alias(c) for c in ("accuracy", "f2_weighted", "critical_recall")]
    )


@query(
    "agg_11_class_report",
    " UNION ALL ".join(
        f"""SELECT dataset_id, CAST({k} AS INTEGER) AS class, '{n}' AS name, round({precision(k)}, 6) AS precision,
       round({recall(k)}, 6) AS recall, round({f_score(k, 1)}, 6) AS f1, {support(k)} AS support FROM {BY_DATASET}"""
        for k, n in enumerate(("Healthy", "Alert", "Critical"))
    ),
    ("judged",),
)
def report(spark, sf_dir):
    rows = class_report(dataset_confusion(spark, sf_dir), ["dataset_id"])
    return rows.select(
        "dataset_id",
        "class",
        "name",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
        "support",
    )


@query(
    "agg_12_average_f1",
    f"SELECT dataset_id, round({MACRO_F1}, 6) AS f1_macro, round({by_support(1)}, 6) AS f1_weighted FROM {BY_DATASET}",
    ("judged",),
)
def averages(spark, sf_dir):
    rows = average_f1(dataset_confusion(spark, sf_dir), ["dataset_id"])
    return rows.select(
        "dataset_id", *[F.round(c, 6).alias(c) for c in ("f1_macro", "f1_weighted")]
    )


_SHARE = f"(CAST({support(0)} AS DOUBLE) / ({support(0)} + {support(1)} + {support(2)}))"


@query(
    "agg_13_baseline",
    f"""SELECT dataset_id, round({_SHARE}, 6) AS baseline_accuracy,
       round(2 * {_SHARE} / ({_SHARE} + 1) / 3, 6) AS baseline_f1_macro, 'Healthy' AS baseline_class FROM {BY_DATASET}""",
    ("judged",),
)
def majority_baseline(spark, sf_dir):
    rows = baseline(dataset_confusion(spark, sf_dir), 0, ["dataset_id"])
    return rows.select(
        "dataset_id",
        *[F.round(c, 6).alias(c) for c in ("baseline_accuracy", "baseline_f1_macro")],
        "baseline_class",
    )


@query(
    "agg_14_mean_loss",
    """SELECT l_suppkey % 10 AS run, CAST(l_linenumber AS INTEGER) AS step, round(avg(l_discount + l_tax), 6) AS train_loss
FROM lineitem GROUP BY ALL""",
)
def loss_per_step(spark, sf_dir):
    """A loss log with one row per batch: line items stand for batches."""
    log = table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).alias("run"),
        F.col("l_linenumber").alias("step"),
        (F.col("l_discount") + F.col("l_tax")).alias("loss"),
    )
    return mean_loss(log, ["run", "step"]).withColumn("train_loss", F.round("train_loss", 6))


@query(
    "agg_14_log_loss",
    """SELECT round(sum(-ln(greatest(p, 1e-15)) * w) / sum(w), 6) AS log_loss FROM (
  SELECT CASE label % 3 WHEN 0 THEN p_healthy WHEN 1 THEN p_alert ELSE p_critical END AS p,
         CAST(1 + label % 3 AS DOUBLE) AS w
  FROM answers JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id))""",
    ("answers",),
)
def log_loss(spark, sf_dir):
    """Class-weighted cross entropy of scored rows."""
    rows = (
        derived.scored(spark, sf_dir)
        .withColumn("truth", F.col("label") % 3)
        .withColumn("w", (1 + F.col("label") % 3).cast("double"))
    )
    loss = weighted_log_loss(rows, "truth", "probabilities", "w")
    return loss.select(F.round("log_loss", 6).alias("log_loss"))


# Bits by the engine's own cast, against the arithmetic of the operator.
_BITS = " || ',' || ".join(f"CAST(CAST(CAST(CAST({c} AS FLOAT) AS BIT) AS BIGINT) AS VARCHAR)" for c in VARYING)
_DIGESTS = f"""(SELECT global_unit, sha256(CAST(position - 30 AS VARCHAR) || '|' || CAST(failure_type AS VARCHAR) || '|' || array_to_string(bits, ',') || '|' || global_unit) AS d
  FROM (SELECT global_unit, failure_type, row_number() OVER ({SERIES}) AS position,
               list({_BITS}) OVER ({SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS bits FROM lab)
  WHERE position >= 30)"""
_LIMBS = " || '|' || ".join(
    f"CAST(sum(CAST(('0x' || substr(d, {15 * i + 1}, 15)) AS HUGEINT)) AS VARCHAR)" for i in range(4)
)


def _digests(spark, sf_dir):
    rows, plan = labeled_series(spark, sf_dir)
    # A plan says that the size check of the line items found nothing to cut.
    return contents_of_series(rows, VARYING, 30, LongSeries(None) if plan else None)


@query(
    "agg_16_engine_digests",
    f"SELECT global_unit AS engine_id, count(*) AS rows, sha256(CAST(count(*) AS VARCHAR) || '|' || {_LIMBS}) AS digest FROM {_DIGESTS} GROUP BY global_unit",
    ("lab",),
)
def engine_digests(spark, sf_dir):
    """Digest of all windows of an engine, each hashed whole."""
    return digest_total(_digests(spark, sf_dir), DIGEST, ["engine_id"])


@query(
    "agg_16_fingerprint",
    f"""SELECT count(*) AS rows, sha256(sha256(CAST(count(*) AS VARCHAR) || '|' || {_LIMBS})
       || '|val=200000;test=200000;seed=42;{",".join(VARYING)}') AS fingerprint FROM {_DIGESTS}""",
    ("lab",),
)
def run_fingerprint(spark, sf_dir):
    """Content of a run: split parameters, feature names and the exact bits of every window."""
    return fingerprint(_digests(spark, sf_dir), VARYING, 0.2, 0.2, 42)


@query(
    "evl_2_diagnostics",
    f"""SELECT dataset_id, round({ACCURACY}, 6) AS accuracy, round({MACRO_F1}, 6) AS f1_macro, round({by_support(1)}, 6) AS f1_weighted,
       {", ".join(f"round({precision(k)}, 6) AS {n}_precision, round({recall(k)}, 6) AS {n}_recall, round({f_score(k, 1)}, 6) AS {n}_f1, {support(k)} AS {n}_support" for k, n in enumerate(("healthy", "alert", "critical")))},
       round({_SHARE}, 6) AS baseline_accuracy, round(2 * {_SHARE} / ({_SHARE} + 1) / 3, 6) AS baseline_f1_macro,
       'Healthy' AS baseline_class, {predicted(2)} AS called_critical FROM {BY_DATASET}""",
    ("judged",),
)
def run_diagnostics(spark, sf_dir):
    rows = diagnostics(dataset_confusion(spark, sf_dir), 0, ["dataset_id"])
    critical = F.aggregate(
        "confusion", F.lit(0).cast("long"), lambda acc, row: acc + F.element_at(row, 3)
    )
    doubles = [c for c, t in rows.dtypes if t == "double"]
    return (
        rows.withColumn("called_critical", critical)
        .drop("confusion")
        .withColumns({c: F.round(c, 6) for c in doubles})
    )


@query(
    "win_3_numbered_lines",
    """SELECT unit_number - 1 AS l_suppkey, count(*) AS lines, max(time_in_cycles) AS last_cycle,
       CAST(sum(time_in_cycles * l_partkey) AS BIGINT) AS checksum FROM tel GROUP BY unit_number""",
    ("tel",),
)
def numbered(spark, sf_dir):
    """Distributed row numbers inside each supplier."""
    return numbered_lines(spark, sf_dir).groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.max(CYCLE).alias("last_cycle"),
        F.sum(F.col(CYCLE) * F.col("l_partkey")).alias("checksum"),
    )
