"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline set).
"""

from __future__ import annotations

import json
import os
import time

from wearspan.queries import QUERIES
from wearspan.session import local_session

HEADLINE = [
    "prj_2_remaining_life",
    "set_2_deduplicated",
    "win_1_sliding_windows",
    "win_2_window_labels",
    "win_4_dense_window_index",
    "agg_3_sensor_spread",
    "agg_4_scaler_state",
    "agg_5_class_weights",
    "agg_8_gate_metrics",
    "agg_16_fingerprint",
    "evl_2_diagnostics",
    "srt_2_best_checkpoint",
    "evl_6_champion_or_challenger",
    "ctr_2_labeled_contract",
    "dst_1_engine_sample",
    "dst_3_three_way_split",
    "dst_6_scaled_rows",
    "dst_7_feature_build",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "bench", spark__sql__shuffle__partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_suppkey").count().count()  # start the JVM's workers
    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows": lines,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
