"""Query registration and the SQL views that the oracle texts share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; `views` names the shared CTEs its SQL starts from."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return function

    return register


def with_views(views: tuple[str, ...], sql: str) -> str:
    needed: list[str] = []

    def add(view: str) -> None:
        for parent in PARENTS.get(view, ()):
            add(parent)
        if view not in needed:
            needed.append(view)

    for view in views:
        add(view)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]})" for v in needed) + "\n" + sql


LINE_ORDER = (
    "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus"
)
FEATURES = [
    "op_setting_1", "op_setting_2", "op_setting_3", "sensor_1", "sensor_2", "sensor_3", "sensor_4",
]
VARYING = ["sensor_1", "sensor_2", "sensor_3", "sensor_4"]
# SQL text of one float32 feature vector and of the order inside an engine.
FLOATS = ", ".join(f"CAST({c} AS FLOAT)" for c in VARYING)
ALL_FLOATS = ", ".join(f"CAST({c} AS FLOAT)" for c in FEATURES)
SERIES = "PARTITION BY global_unit ORDER BY time_in_cycles, " + ", ".join(VARYING)
ALL_SERIES = "PARTITION BY global_unit ORDER BY time_in_cycles, " + ", ".join(FEATURES)

COLUMNS = (
    "unit_number, time_in_cycles, op_setting_1, op_setting_2, op_setting_3, "
    "sensor_1, sensor_2, sensor_3, sensor_4, sensor_5, dataset_id, global_unit"
)

VIEWS = {
    "tel": f"""
  SELECT l_suppkey + 1 AS unit_number,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY {LINE_ORDER}) AS time_in_cycles,
         CAST(l_linenumber AS DOUBLE) AS op_setting_1,
         CAST(l_partkey % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS op_setting_2,
         CAST(100 AS DOUBLE) AS op_setting_3,
         l_quantity AS sensor_1, l_extendedprice AS sensor_2,
         l_discount AS sensor_3, l_tax AS sensor_4, CAST(518.67 AS DOUBLE) AS sensor_5,
         'FD00' || CAST(l_suppkey % 4 + 1 AS VARCHAR) AS dataset_id,
         'FD00' || CAST(l_suppkey % 4 + 1 AS VARCHAR) || '_' || CAST(l_suppkey + 1 AS VARCHAR) AS global_unit,
         l_orderkey, l_partkey
  FROM lineitem""",
    "lab": """
  SELECT *, CASE WHEN RUL <= 30 THEN 2 WHEN RUL <= 60 THEN 1 ELSE 0 END AS failure_type
  FROM (SELECT *, max(time_in_cycles) OVER (PARTITION BY global_unit) - time_in_cycles AS RUL FROM tel)""",
    "copied": f"""
  SELECT {COLUMNS}, RUL, failure_type FROM lab
  UNION ALL SELECT {COLUMNS}, RUL, failure_type FROM lab WHERE l_orderkey % 50 = 0""",
    "clean": f"SELECT DISTINCT {COLUMNS}, RUL, failure_type FROM copied",
    "framed": f"""
  SELECT global_unit, time_in_cycles, failure_type, dataset_id,
         list([{FLOATS}]) OVER ({SERIES} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS readings
  FROM lab""",
    "win": """
  SELECT global_unit AS engine_id, time_in_cycles AS end_cycle, failure_type, dataset_id, readings
  FROM framed WHERE len(readings) = 30""",
    "numbered": f"""
  SELECT *, row_number() OVER ({ALL_SERIES}) AS position,
         count(*) OVER (PARTITION BY global_unit) AS engine_rows
  FROM clean""",
    "engines": "SELECT DISTINCT dataset_id, global_unit FROM tel",
    "placed": """
  SELECT global_unit, CASE WHEN r <= n_test THEN 'test'
              WHEN r <= n_test + CAST(ceil(CAST(0.2 AS DOUBLE) / (CAST(1 AS DOUBLE) - CAST(0.2 AS DOUBLE)) * CAST(n - n_test AS DOUBLE)) AS BIGINT) THEN 'val'
              ELSE 'train' END AS split
  FROM (SELECT global_unit, n, CAST(ceil(CAST(0.2 AS DOUBLE) * CAST(n AS DOUBLE)) AS BIGINT) AS n_test,
               row_number() OVER (ORDER BY md5('42|' || global_unit), global_unit) AS r
        FROM (SELECT global_unit, count(*) OVER () AS n FROM engines))""",
    "feed": """
  SELECT 'U_' || CAST(user_id AS VARCHAR) AS global_unit, epoch_us(ts) AS time_in_cycles,
         value AS sensor_1, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS sensor_2
  FROM events""",
    "judged": """
  SELECT *, CASE WHEN level >= 8 THEN 2 WHEN level >= 5 THEN 1 ELSE 0 END AS predicted
  FROM (SELECT *, CAST(round(sensor_3 * 100) AS INTEGER) AS level FROM lab)""",
    "history_cells": """
  SELECT 'run_' || global_unit AS run_id, step, failure_type AS t,
         CASE WHEN level >= step THEN 2 WHEN level >= step - 3 THEN 1 ELSE 0 END AS p
  FROM judged, (SELECT CAST(unnest(generate_series(0, 10)) AS INTEGER) AS step)""",
    "history_counts": """
  SELECT run_id, step, """
    + ", ".join(
        f"count(*) FILTER (WHERE t = {t} AND p = {p}) AS t{t}_p{p}" for t in range(3) for p in range(3)
    )
    + " FROM history_cells GROUP BY run_id, step",
    "promotions": """
  SELECT 'model_' || CAST(o_custkey % 40 AS VARCHAR) AS model_name, o_orderkey AS version,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              ELSE 'run_FD00' || CAST((o_orderkey % 120) % 4 + 1 AS VARCHAR) || '_' || CAST(o_orderkey % 120 + 1 AS VARCHAR)
         END AS run_id,
         o_orderdate AS promoted_at
  FROM orders""",
    "champion": """
  SELECT model_name, version, run_id, promoted_at
  FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY promoted_at DESC, version DESC) AS r FROM promotions)
  WHERE r = 1""",
    "challengers": """
  SELECT 'model_' || CAST(c_custkey % 45 AS VARCHAR) AS model_name,
         'try_' || CAST(c_custkey AS VARCHAR) AS run_id,
         'fp_' || CAST(c_custkey % 3 AS VARCHAR) AS fingerprint,
         abs(c_acctbal) / CAST(10000 AS DOUBLE) AS f2_weighted,
         CAST(c_nationkey AS DOUBLE) / CAST(25 AS DOUBLE) AS critical_recall
  FROM customer""",
    "judged_challengers": """
  SELECT c.*, champion.version AS champion_version,
         (c.f2_weighted >= CAST(0.3 AS DOUBLE) AND c.critical_recall >= CAST(0.2 AS DOUBLE)) AS passes,
         CASE WHEN champion.version IS NULL THEN 'no_champion'
              WHEN champion.run_id IS NULL THEN 'champion_without_run'
              WHEN r.fingerprint IS DISTINCT FROM c.fingerprint THEN 'other_data'
              WHEN r.f2_weighted IS NULL THEN 'champion_without_f2'
              WHEN c.f2_weighted >= r.f2_weighted THEN 'not_worse'
              ELSE 'worse' END AS reason
  FROM challengers c LEFT JOIN champion ON c.model_name = champion.model_name
       LEFT JOIN engine_runs r ON champion.run_id = r.run_id""",
    "shapes": """
  SELECT 'run_' || CAST(s_suppkey AS VARCHAR) AS run_id,
         CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 8 = 0 THEN -1 ELSE 20 END AS window_size,
         CASE WHEN s_suppkey % 5 = 0 THEN 8 ELSE 7 END AS model_features,
         7 AS scaler_features
  FROM supplier""",
    "requests": """
  SELECT vec_id,
         CASE WHEN vec_id % 17 = 0 THEN '   ' WHEN vec_id % 19 = 0 THEN repeat('e', 65)
              ELSE 'ENG_' || CAST(label AS VARCHAR) || '_' || CAST(vec_id AS VARCHAR) END AS engine_id,
         CASE WHEN vec_id % 23 = 0 THEN CAST([] AS DOUBLE[][])
              ELSE list_transform(generate_series(0, 7), lambda i:
                     CASE WHEN vec_id % 7 = 0 AND i = 3 THEN CAST(embedding[i * 8 + 1 : i * 8 + 7] AS DOUBLE[])
                          WHEN vec_id % 11 = 0 AND i = 5 THEN list_append(CAST(embedding[i * 8 + 1 : i * 8 + 7] AS DOUBLE[]), CAST('NaN' AS DOUBLE))
                          ELSE CAST(embedding[i * 8 + 1 : i * 8 + 8] AS DOUBLE[]) END)
         END AS readings
  FROM embeddings""",
    "scored": """
  SELECT vec_id, label, s, [exp(s[1] - m), exp(s[2] - m), exp(s[3] - m)] AS e
  FROM (SELECT vec_id, label, s, greatest(s[1], s[2], s[3]) AS m
        FROM (SELECT vec_id, label, [CAST(embedding[1] AS DOUBLE) * 10, CAST(embedding[2] AS DOUBLE) * 10, CAST(embedding[3] AS DOUBLE) * 10] AS s
              FROM embeddings))""",
    "answers": """
  SELECT vec_id, 'ENG_' || CAST(label AS VARCHAR) AS engine_id,
         CASE WHEN e[1] >= e[2] AND e[1] >= e[3] THEN 'Healthy' WHEN e[2] >= e[3] THEN 'Alert' ELSE 'Critical' END AS prediction,
         e[1] / (e[1] + e[2] + e[3]) AS p_healthy, e[2] / (e[1] + e[2] + e[3]) AS p_alert, e[3] / (e[1] + e[2] + e[3]) AS p_critical
  FROM scored""",
}


def _ratio(top: str, bottom: str) -> str:
    return f"coalesce(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0), 0)"


def support(k: int) -> str:
    return "(" + " + ".join(f"t{k}_p{p}" for p in range(3)) + ")"


def predicted(k: int) -> str:
    return "(" + " + ".join(f"t{t}_p{k}" for t in range(3)) + ")"


TOTAL = "(" + " + ".join(support(k) for k in range(3)) + ")"
ACCURACY = _ratio("t0_p0 + t1_p1 + t2_p2", TOTAL)


def precision(k: int) -> str:
    return _ratio(f"t{k}_p{k}", predicted(k))


def recall(k: int) -> str:
    return _ratio(f"t{k}_p{k}", support(k))


def f_score(k: int, squared: int) -> str:
    tp = f"t{k}_p{k}"
    return _ratio(
        f"{1 + squared} * {tp}",
        f"({1 + squared} * {tp} + {squared} * ({support(k)} - {tp}) + ({predicted(k)} - {tp}))",
    )


def by_support(squared: int) -> str:
    return _ratio("(" + " + ".join(f"{f_score(k, squared)} * {support(k)}" for k in range(3)) + ")", TOTAL)


MACRO_F1 = "(" + " + ".join(f_score(k, 1) for k in range(3)) + ") / 3"

VIEWS["history"] = (
    f"SELECT run_id, step, {ACCURACY} AS accuracy, {by_support(4)} AS f2_weighted, "
    f"{recall(2)} AS critical_recall FROM history_counts"
)
VIEWS["run_counts"] = (
    "SELECT global_unit, unit_number, "
    + ", ".join(
        f"count(*) FILTER (WHERE failure_type = {t} AND predicted = {p}) AS t{t}_p{p}"
        for t in range(3)
        for p in range(3)
    )
    + " FROM judged GROUP BY global_unit, unit_number"
)
VIEWS["engine_runs"] = (
    "SELECT 'run_' || global_unit AS run_id, 'fp_' || CAST((t0_p0 + t0_p1 + t0_p2) % 3 AS VARCHAR) AS fingerprint, "
    f"CASE WHEN unit_number % 7 = 0 THEN NULL ELSE {by_support(4)} END AS f2_weighted FROM run_counts"
)

PARENTS = {
    "lab": ("tel",),
    "copied": ("lab",),
    "clean": ("copied",),
    "framed": ("lab",),
    "win": ("framed",),
    "numbered": ("clean",),
    "engines": ("tel",),
    "placed": ("engines",),
    "judged": ("lab",),
    "history_cells": ("judged",),
    "history_counts": ("history_cells",),
    "history": ("history_counts",),
    "champion": ("promotions",),
    "run_counts": ("judged",),
    "engine_runs": ("run_counts",),
    "judged_challengers": ("challengers", "champion", "engine_runs"),
    "answers": ("scored",),
}
