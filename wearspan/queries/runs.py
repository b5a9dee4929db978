"""Selection, registry and lineage over run tables derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.operators.lineage import lineage_tags
from wearspan.operators.registry import (
    champion_runs,
    champions,
    consistent_shapes,
    describe_champions,
    judge_challengers,
)
from wearspan.operators.selection import (
    best_checkpoints,
    completed_steps,
    gate_runs,
    patience_counter,
    stop_steps,
)
from wearspan.queries.catalog import query
from wearspan.session import scratch_path
from wearspan.sources import derived
from wearspan.sources.bindings import table
from wearspan.sources.ledger import Ledger

F2_LIMIT, RECALL_LIMIT = 0.5, 0.3
_PASSES = "(f2_weighted >= CAST(0.5 AS DOUBLE) AND critical_recall >= CAST(0.3 AS DOUBLE))"

_COUNTED = """(SELECT run_id, step, f2_weighted, critical_recall, best_f2, improved,
       CAST(position - coalesce(max(CASE WHEN improved THEN position END) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING), 0) AS INTEGER) AS since_improved
  FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY step) AS position,
               max(f2_weighted) OVER (PARTITION BY run_id ORDER BY step ROWS UNBOUNDED PRECEDING) AS best_f2,
               f2_weighted > coalesce(max(f2_weighted) OVER (PARTITION BY run_id ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS improved
        FROM history))"""


@query(
    "win_7_patience_counter",
    f"SELECT run_id, step, round(best_f2, 6) AS best_f2, improved, since_improved FROM {_COUNTED}",
    ("history",),
)
def counter(spark, sf_dir):
    return patience_counter(derived.history(spark, sf_dir)).select(
        "run_id", "step", F.round("best_f2", 6).alias("best_f2"), "improved", "since_improved"
    )


@query(
    "win_8_stop_steps",
    f"SELECT run_id, min(step) FILTER (WHERE since_improved >= 3) AS stop_step FROM {_COUNTED} GROUP BY run_id",
    ("history",),
)
def stops(spark, sf_dir):
    return stop_steps(derived.history(spark, sf_dir), 3)


@query(
    "evl_5_completed_steps",
    f"""SELECT run_id, step FROM (SELECT *, min(CASE WHEN since_improved >= 2 THEN step END) OVER (PARTITION BY run_id) AS stop_step FROM {_COUNTED})
WHERE stop_step IS NULL OR step <= stop_step""",
    ("history",),
)
def completed(spark, sf_dir):
    return completed_steps(derived.history(spark, sf_dir), 2).select("run_id", "step")


@query(
    "srt_2_best_checkpoint",
    f"""SELECT run_id, step, passes, round(f2_weighted, 6) AS f2_weighted FROM (
  SELECT run_id, step, f2_weighted, {_PASSES} AS passes,
         row_number() OVER (PARTITION BY run_id ORDER BY {_PASSES} DESC, f2_weighted DESC, step) AS r FROM history) WHERE r = 1""",
    ("history",),
)
def checkpoint(spark, sf_dir):
    """Gate first, then F2, then the earliest step (EVL-4)."""
    best = best_checkpoints(derived.history(spark, sf_dir), F2_LIMIT, RECALL_LIMIT)
    return best.select("run_id", "step", "passes", F.round("f2_weighted", 6).alias("f2_weighted"))


@query(
    "evl_3_quality_gate",
    f"SELECT run_id, step, {_PASSES} AS passes FROM history",
    ("history",),
)
def gated(spark, sf_dir):
    return gate_runs(derived.history(spark, sf_dir), F2_LIMIT, RECALL_LIMIT).select(
        "run_id", "step", "passes"
    )


@query("scr_2_champions", "SELECT model_name, version, run_id FROM champion", ("champion",))
def resolved(spark, sf_dir):
    return champions(derived.promotions(spark, sf_dir)).select("model_name", "version", "run_id")


@query(
    "jn_6_champion_runs",
    """SELECT model_name, version, champion.run_id, fingerprint, round(f2_weighted, 6) AS f2_weighted
FROM champion LEFT JOIN engine_runs ON champion.run_id = engine_runs.run_id""",
    ("champion", "engine_runs"),
)
def looked_up(spark, sf_dir):
    rows = champion_runs(derived.promotions(spark, sf_dir), derived.engine_runs(spark, sf_dir))
    return rows.select(
        "model_name", "version", "run_id", "fingerprint", F.round("f2_weighted", 6).alias("f2_weighted")
    )


def _judged(spark, sf_dir):
    candidates = gate_runs(derived.challengers(spark, sf_dir), 0.3, 0.2)
    return judge_challengers(
        candidates, derived.promotions(spark, sf_dir), derived.engine_runs(spark, sf_dir)
    )


@query(
    "evl_6_champion_or_challenger",
    """SELECT run_id, model_name, reason, reason <> 'worse' AS replaces FROM judged_challengers""",
    ("judged_challengers",),
)
def challengers(spark, sf_dir):
    return _judged(spark, sf_dir).select("run_id", "model_name", "reason", "replaces")


@query(
    "evl_7_promotion_outcome",
    """SELECT CASE WHEN NOT passes THEN 'gate_failed' WHEN reason <> 'worse' THEN 'promoted' ELSE 'champion_is_better' END AS outcome,
       reason, count(*) AS runs FROM judged_challengers GROUP BY ALL""",
    ("judged_challengers",),
)
def outcomes(spark, sf_dir):
    return _judged(spark, sf_dir).groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("runs"))


@query(
    "jn_7_artifact_shapes",
    """SELECT run_id, CAST(CASE WHEN window_size > 0 THEN window_size ELSE 30 END AS INTEGER) AS window_size, scaler_features AS num_features,
       NOT coalesce(window_size > 0, false) OR model_features = scaler_features AS consistent FROM shapes""",
    ("shapes",),
)
def artifact_shapes(spark, sf_dir):
    return consistent_shapes(derived.shapes(spark, sf_dir), 30)


@query(
    "scr_6_model_description",
    """SELECT 'ok' AS status, 'model_' || n_name AS model_name, CAST(v AS VARCHAR) AS model_version,
       CAST(CASE WHEN window_size > 0 THEN window_size ELSE 30 END AS INTEGER) AS window_size, 7 AS num_features,
       'f0,f1,f2,f3,f4,f5,f6' AS feature_names
FROM (SELECT s_nationkey, arg_max(s_suppkey, [s_acctbal, s_suppkey]) AS v FROM supplier GROUP BY s_nationkey) b
JOIN nation ON n_nationkey = s_nationkey JOIN shapes ON run_id = 'run_' || CAST(v AS VARCHAR)
WHERE NOT coalesce(window_size > 0, false) OR model_features = scaler_features""",
    ("shapes",),
)
def description(spark, sf_dir):
    """A model per nation whose champion is its richest supplier's run."""
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    promoted = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("model_"), "n_name").alias("model_name"),
        F.col("s_suppkey").alias("version"),
        F.concat(F.lit("run_"), F.col("s_suppkey").cast("string")).alias("run_id"),
        F.col("s_acctbal").alias("promoted_at"),
    )
    manifests = derived.shapes(spark, sf_dir).select(
        "run_id",
        F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.concat(F.lit("f"), i.cast("string")))).alias(
            "position", "feature"
        ),
    )
    rows = describe_champions(promoted, derived.shapes(spark, sf_dir), manifests, 30)
    return rows.withColumn("feature_names", F.array_join("feature_names", ","))


@query(
    "src_8_run_ledger",
    """SELECT run_id, CAST(step AS INTEGER) AS step, metric, round(value, 6) AS value FROM (
  SELECT run_id, step, 'accuracy' AS metric, accuracy AS value FROM history
  UNION ALL SELECT run_id, step, 'f2_weighted', f2_weighted FROM history
  UNION ALL SELECT run_id, step, 'critical_recall', critical_recall FROM history)""",
    ("history",),
)
def ledger_metrics(spark, sf_dir):
    """Step metrics appended to the ledger in long form and read back."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    ledger.append_history(
        derived.history(spark, sf_dir), ["accuracy", "f2_weighted", "critical_recall"]
    )
    return ledger.metrics().withColumn("value", F.round("value", 6))


@query(
    "dst_8_lineage",
    """SELECT run_id, name, value FROM (SELECT run_id, fingerprint FROM engine_runs),
  LATERAL (VALUES ('code_version', 'abc123'), ('code_dirty', 'false'), ('data_hash', 'unknown'), ('data_dir', 'lineitem'),
    ('image_tag', 'abc123'), ('fingerprint', fingerprint)) t(name, value)""",
    ("engine_runs",),
)
def lineage(spark, sf_dir):
    """Lineage rows of every run: job arguments plus the run's own data fingerprint."""
    tags = lineage_tags(code_version="abc123", dirty=False, data_dir="lineitem")
    fixed = [F.struct(F.lit(k).alias("name"), F.lit(v).alias("value")) for k, v in tags.items()]
    own = F.struct(F.lit("fingerprint").alias("name"), F.col("fingerprint").alias("value"))
    return derived.engine_runs(spark, sf_dir).select("run_id", F.inline(F.array(*fixed, own)))


