"""Array, JSON and hash functions over embeddings and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from wearspan.functions.arrays import all_finite, has_shape, is_rectangular, reshape
from wearspan.functions.scores import argmax, class_name
from wearspan.operators.scoring import named_readings
from wearspan.queries.catalog import query
from wearspan.sources import derived
from wearspan.sources.bindings import table
from wearspan.sources.requests import parse_request, request_json
from wearspan.sources.tables import manifest

NAMES = [f"signal_{i}" for i in range(8)]


@query(
    "fn_13_reshaped",
    """SELECT vec_id, CAST(i AS INTEGER) AS step,
       CAST(list_sum(list_transform(embedding[i * 8 + 1 : i * 8 + 8], lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT))) AS BIGINT) AS total
FROM embeddings, (SELECT unnest(generate_series(0, 7)) AS i)""",
)
def reshaped(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.posexplode(reshape(F.col("embedding"), 8, 8)).alias("step", "row")
    )
    total = F.aggregate(
        "row",
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.round(x.cast("double") * 1000000).cast("long"),
    )
    return rows.select("vec_id", "step", total.alias("total"))


@query(
    "fn_14_rectangular",
    """SELECT vec_id, (len(readings) > 0 AND coalesce(len(readings[1]), 0) > 0
       AND len(list_filter(readings, lambda r: len(r) <> len(readings[1]))) = 0) AS rectangular FROM requests""",
    ("requests",),
)
def rectangular(spark, sf_dir):
    return derived.requests(spark, sf_dir).select(
        "vec_id", is_rectangular(F.col("readings")).alias("rectangular")
    )


@query(
    "fn_15_finite",
    """SELECT vec_id, len(list_filter(flatten(readings), lambda x: isnan(x) OR isinf(x))) = 0 AS finite FROM requests""",
    ("requests",),
)
def finite(spark, sf_dir):
    return derived.requests(spark, sf_dir).select(
        "vec_id", all_finite(F.flatten("readings")).alias("finite")
    )


@query(
    "fn_16_lengths",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE len(embedding) % 8 = 0) AS divisible,
       count(*) FILTER (WHERE len(flatten(readings)) = 64) AS complete,
       count(*) FILTER (WHERE len(readings) = 8 AND len(list_filter(readings, lambda r: len(r) <> 8)) = 0) AS shaped
FROM requests JOIN embeddings USING (vec_id)""",
    ("requests",),
)
def lengths(spark, sf_dir):
    rows = derived.requests(spark, sf_dir).join(table(spark, sf_dir, "embeddings"), "vec_id")
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size("embedding") % 8 == 0).alias("divisible"),
        F.count_if(F.size(F.flatten("readings")) == 64).alias("complete"),
        F.count_if(has_shape(F.col("readings"), 8, 8)).alias("shaped"),
    )


@query(
    "fn_9_softmax",
    "SELECT vec_id, round(p_healthy, 6) AS p_healthy, round(p_alert, 6) AS p_alert, round(p_critical, 6) AS p_critical FROM answers",
    ("answers",),
)
def probabilities(spark, sf_dir):
    p = F.col("probabilities")
    return derived.scored(spark, sf_dir).select(
        "vec_id",
        *[
            F.round(F.get(p, F.lit(i)), 6).alias(name)
            for i, name in enumerate(("p_healthy", "p_alert", "p_critical"))
        ],
    )


@query("srt_3_argmax", "SELECT vec_id, prediction FROM answers", ("answers",))
def predictions(spark, sf_dir):
    return derived.class_scores(spark, sf_dir).select(
        "vec_id", class_name(argmax(F.col("scores"))).alias("prediction")
    )


@query(
    "srt_3_argmax_ties",
    """SELECT b, CAST(CASE WHEN h >= a AND h >= c THEN 0 WHEN a >= c THEN 1 ELSE 2 END AS INTEGER) AS predicted, count(*) AS parts
FROM (SELECT p_brand AS b, p_size % 3 AS h, p_partkey % 3 AS a, p_size % 2 AS c FROM part) GROUP BY ALL""",
)
def ties(spark, sf_dir):
    """Small integer scores tie often: the lowest class wins."""
    size = F.col("p_size").cast("long")
    scores = F.array(size % 3, F.col("p_partkey") % 3, size % 2)
    return table(spark, sf_dir, "part").groupBy(
        F.col("p_brand").alias("b"), argmax(scores).alias("predicted")
    ).agg(F.count(F.lit(1)).alias("parts"))


@query(
    "prj_11_named_readings",
    """SELECT 'signal_' || CAST(k AS VARCHAR) AS feature, count(*) AS values_bound,
       CAST(sum(CAST(round(CAST(embedding[i * 8 + k + 1] AS DOUBLE) * 1000000) AS BIGINT)) AS BIGINT) AS total
FROM embeddings, (SELECT unnest(generate_series(0, 7)) AS i), (SELECT unnest(generate_series(0, 7)) AS k)
GROUP BY k""",
)
def named(spark, sf_dir):
    requests = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("engine_id"),
        reshape(F.col("embedding").cast("array<double>"), 8, 8).alias("readings"),
    )
    return named_readings(requests, manifest(spark, NAMES)).groupBy("feature").agg(
        F.count(F.lit(1)).alias("values_bound"),
        F.sum(F.round(F.col("value") * 1000000).cast("long")).alias("total"),
    )


@query(
    "fn_18_json_round_trip",
    """SELECT vec_id, 'ENG_' || CAST(label AS VARCHAR) AS engine_id, CAST(8 AS INTEGER) AS steps,
       CAST(list_sum(list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT))) AS BIGINT) AS total
FROM embeddings""",
)
def json_round_trip(spark, sf_dir):
    """Write requests as JSON text and parse them back with a declared schema."""
    rows = table(spark, sf_dir, "embeddings")
    text = request_json(
        F.concat(F.lit("ENG_"), F.col("label").cast("string")),
        reshape(F.col("embedding").cast("array<double>"), 8, 8),
    )
    parsed = rows.select("vec_id", parse_request(text).alias("r"))
    total = F.aggregate(
        F.flatten("r.readings"),
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.round(x * 1000000).cast("long"),
    )
    return parsed.select(
        "vec_id",
        F.col("r.engine_id").alias("engine_id"),
        F.size("r.readings").alias("steps"),
        total.alias("total"),
    )


@query("fn_19_text_digests", "SELECT doc_id, sha256(text) AS digest FROM documents")
def text_digests(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query(
    "fn_10_rounded",
    "SELECT vec_id, list_sum(list_transform(embedding, lambda x: CAST(round(CAST(x AS DOUBLE), 6) * 1000000 AS BIGINT))) AS micro FROM embeddings",
)
def rounded(spark, sf_dir):
    micro = F.aggregate(
        "embedding",
        F.lit(0).cast("long"),
        lambda acc, x: acc + F.round(F.round(x.cast("double"), 6) * 1000000).cast("long"),
    )
    return table(spark, sf_dir, "embeddings").select("vec_id", micro.alias("micro"))
