"""Projections, filters, set operations and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from wearspan.functions.scores import class_name, standardise
from wearspan.operators.contracts import not_blank, text_length
from wearspan.operators.labeling import (
    clean_telemetry,
    drop_duplicate_rows,
    feature_columns,
    health_class,
)
from wearspan.operators.sampling import engine_table
from wearspan.queries.catalog import FEATURES, query
from wearspan.schemas import CYCLE, ENTITY, LABEL, SUB_DATASETS
from wearspan.sources.bindings import labeled, table, telemetry, with_copies


@query(
    "prj_1_entity_keys",
    "SELECT DISTINCT dataset_id, global_unit, unit_number FROM tel",
    ("tel",),
)
def entity_keys(spark, sf_dir):
    return telemetry(spark, sf_dir).select("dataset_id", ENTITY, "unit_number").distinct()


@query(
    "prj_2_remaining_life",
    "SELECT global_unit, time_in_cycles, RUL, failure_type FROM lab",
    ("lab",),
)
def remaining_life(spark, sf_dir):
    return labeled(spark, sf_dir).select(ENTITY, CYCLE, "RUL", LABEL)


@query(
    "prj_3_health_class",
    """SELECT o_orderpriority, CASE WHEN d <= 30 THEN 2 WHEN d <= 60 THEN 1 ELSE 0 END AS health, count(*) AS orders
FROM (SELECT o_orderpriority, date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS d FROM orders)
GROUP BY ALL""",
)
def health_by_age(spark, sf_dir):
    """The class rule on any remaining count: days from each order to the last one."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderdate")).scalar()
    days = F.datediff(F.to_date(last), F.to_date("o_orderdate"))
    return orders.groupBy("o_orderpriority", health_class(days).alias("health")).agg(
        F.count(F.lit(1)).alias("orders")
    )


@query(
    "prj_4_dropped_helpers",
    """SELECT global_unit, unit_number, time_in_cycles, failure_type, op_setting_1, op_setting_2, op_setting_3,
       sensor_1, sensor_2, sensor_3, sensor_4 FROM clean""",
    ("clean",),
)
def dropped_helpers(spark, sf_dir):
    """Cleaned telemetry: duplicates, the flat sensor and the helper columns are gone."""
    return clean_telemetry(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))


_SPREADS = " UNION ALL ".join(
    [f"SELECT {i} AS ord, 'op_setting_{i}' AS feature, CAST(NULL AS DOUBLE) AS spread" for i in (1, 2, 3)]
    + [
        f"SELECT {3 + i} AS ord, 'sensor_{i}' AS feature, (SELECT stddev_samp(sensor_{i}) FROM clean) AS spread"
        for i in range(1, 6)
    ]
)


@query(
    "prj_6_feature_list",
    f"""SELECT CAST(row_number() OVER (ORDER BY ord) - 1 AS INTEGER) AS position, feature
FROM ({_SPREADS}) WHERE spread IS NULL OR spread >= 1e-6""",
    ("clean",),
)
def feature_list(spark, sf_dir):
    clean = clean_telemetry(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))
    return spark.createDataFrame(
        list(enumerate(feature_columns(clean))), "position int, feature string"
    )


@query(
    "prj_7_float32",
    """SELECT global_unit, CAST(sum(CAST(round(CAST(CAST(sensor_2 / 7 AS FLOAT) AS DOUBLE) * 1000) AS BIGINT)) AS BIGINT) AS narrowed,
       count(*) FILTER (WHERE CAST(CAST(sensor_2 / 7 AS FLOAT) AS DOUBLE) <> sensor_2 / 7) AS changed
FROM tel GROUP BY global_unit""",
    ("tel",),
)
def narrowed(spark, sf_dir):
    exact = F.col("sensor_2") / F.lit(7.0)
    single = exact.cast("float").cast("double")
    return telemetry(spark, sf_dir).groupBy(ENTITY).agg(
        F.sum(F.round(single * 1000).cast("long")).alias("narrowed"),
        F.count_if(single != exact).alias("changed"),
    )


@query(
    "prj_8_class_names",
    """SELECT dataset_id, CASE failure_type WHEN 0 THEN 'Healthy' WHEN 1 THEN 'Alert' ELSE 'Critical' END AS name, count(*) AS cycles
FROM lab GROUP BY ALL""",
    ("lab",),
)
def class_names(spark, sf_dir):
    return labeled(spark, sf_dir).groupBy("dataset_id", class_name(F.col(LABEL)).alias("name")).agg(
        F.count(F.lit(1)).alias("cycles")
    )


@query(
    "prj_10_numeric_paths",
    """SELECT dataset_id,
       CAST(sum(CAST(round(CAST(CAST((sensor_2 / 7 - 5000.25) / 1234.5 AS FLOAT) AS DOUBLE) * 10000) AS BIGINT)) AS BIGINT) AS scored,
       CAST(sum(CAST(round(CAST(CAST((CAST(CAST(sensor_2 / 7 AS FLOAT) AS DOUBLE) - 5000.25) / 1234.5 AS FLOAT) AS DOUBLE) * 10000) AS BIGINT)) AS BIGINT) AS trained
FROM tel GROUP BY dataset_id""",
    ("tel",),
)
def numeric_paths(spark, sf_dir):
    """Scoring scales doubles and narrows after; training narrows first."""
    exact = F.col("sensor_2") / F.lit(7.0)
    mean, std = F.lit(5000.25), F.lit(1234.5)

    def total(value):
        scaled = standardise(value, mean, std).cast("float").cast("double")
        return F.sum(F.round(scaled * 10000).cast("long"))

    return telemetry(spark, sf_dir).groupBy("dataset_id").agg(
        total(exact).alias("scored"), total(exact.cast("float").cast("double")).alias("trained")
    )


@query(
    "set_1_union_of_sub_datasets",
    """SELECT dataset_id, count(*) AS rows, CAST(sum(time_in_cycles) AS BIGINT) AS cycles FROM (
  SELECT * FROM tel WHERE dataset_id = 'FD001' UNION ALL SELECT * FROM tel WHERE dataset_id = 'FD002'
  UNION ALL SELECT * FROM tel WHERE dataset_id = 'FD003' UNION ALL SELECT * FROM tel WHERE dataset_id = 'FD004')
GROUP BY dataset_id""",
    ("tel",),
)
def union_of_sub_datasets(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    parts = [rows.filter(F.col("dataset_id") == d) for d in SUB_DATASETS]
    combined = reduce(lambda a, b: a.unionByName(b), parts)
    return combined.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(CYCLE).alias("cycles")
    )


@query(
    "set_2_distinct_rows",
    """SELECT a.global_unit, a.rows_before, b.rows_after
FROM (SELECT global_unit, count(*) AS rows_before FROM copied GROUP BY global_unit) a
JOIN (SELECT global_unit, count(*) AS rows_after FROM clean GROUP BY global_unit) b ON a.global_unit = b.global_unit""",
    ("clean",),
)
def distinct_rows(spark, sf_dir):
    """Exact copies, counted with and without: grouping by the whole row gives both at once."""
    rows = with_copies(labeled(spark, sf_dir, ("l_orderkey",)))
    groups = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.groupBy(ENTITY).agg(
        F.sum("_copies").alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    )


@query(
    "set_2_deduplicated",
    "SELECT dataset_id, count(*) AS rows, CAST(round(sum(sensor_2), 2) AS DOUBLE) AS total FROM clean GROUP BY dataset_id",
    ("clean",),
)
def deduplicated(spark, sf_dir):
    rows = drop_duplicate_rows(with_copies(labeled(spark, sf_dir, ("l_orderkey",))))
    return rows.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("sensor_2"), 2).alias("total")
    )


@query("set_3_distinct_engines", "SELECT dataset_id, global_unit FROM engines", ("engines",))
def distinct_engines(spark, sf_dir):
    return engine_table(telemetry(spark, sf_dir))


@query(
    "fn_3_usable_identifiers",
    """SELECT count(*) AS pages, count(*) FILTER (WHERE length(url) BETWEEN 1 AND 64) AS fits,
       count(*) FILTER (WHERE trim(url) <> '') AS not_blank FROM pages""",
)
def usable_identifiers(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(text_length(1, 64).good(url)).alias("fits"),
        F.count_if(not_blank().good(url)).alias("not_blank"),
    )


@query(
    "fn_4_column_families",
    f"""SELECT dataset_id, count(*) AS rows, round(sum({' + '.join(FEATURES[:3])}), 3) AS settings,
       round(sum(sensor_1 + sensor_2 + sensor_3 + sensor_4 + sensor_5), 2) AS sensors FROM tel GROUP BY dataset_id""",
    ("tel",),
)
def column_families(spark, sf_dir):
    """Columns picked by name pattern."""
    rows = telemetry(spark, sf_dir)
    settings = rows.select(rows.colRegex(r"`^op_setting_[1-3]$`")).columns
    sensors = rows.select(rows.colRegex(r"`^sensor_\d+$`")).columns

    def total(names):
        return F.sum(reduce(lambda a, b: a + b, [F.col(c) for c in names]))

    return rows.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(total(settings), 3).alias("settings"),
        F.round(total(sensors), 2).alias("sensors"),
    )


@query(
    "fn_8_standardised",
    """SELECT global_unit, CAST(sum(CAST(round((sensor_1 - 25.5) / 14.5 * 1000000) AS BIGINT)) AS BIGINT) AS varying,
       CAST(sum(CAST(round((sensor_5 - 500) / 1 * 1000) AS BIGINT)) AS BIGINT) AS flat FROM tel GROUP BY global_unit""",
    ("tel",),
)
def standardised(spark, sf_dir):
    """A zero std divides by one."""
    varying = standardise(F.col("sensor_1"), F.lit(25.5), F.lit(14.5)) * 1000000
    flat = standardise(F.col("sensor_5"), F.lit(500.0), F.lit(0.0)) * 1000
    return telemetry(spark, sf_dir).groupBy(ENTITY).agg(
        F.sum(F.round(varying).cast("long")).alias("varying"),
        F.sum(F.round(flat).cast("long")).alias("flat"),
    )
