"""Small frames and plain-Python references."""

from __future__ import annotations

import math
import random

import numpy as np

TELEMETRY = (
    "unit_number long, time_in_cycles long, op_setting_1 double, op_setting_2 double, "
    "op_setting_3 double, sensor_1 double, sensor_2 double, dataset_id string, global_unit string"
)
CLEAN = "unit_number long, time_in_cycles long, global_unit string, sensor_1 double, sensor_2 double, failure_type int"


def one_engine(spark):
    """A pump that ran three early readings and one at its end; the second gauge is stuck."""
    gauge = {3: 41.5, 5: 41.75, 9: 43.0, 88: 60.25}
    rows = [(4, cycle, 1.5, -1.5, 75.0, value, 7.0, "FD003", "FD003_4") for cycle, value in gauge.items()]
    return spark.createDataFrame(rows, TELEMETRY)


def origin_rows(cycles=6):
    """Three engines of growing length whose gauge names the engine in its tens of thousands."""
    lengths = {"left": cycles, "mid": cycles + 1, "right": cycles + 3}
    return [
        (n, 2 * i, name, 10_000.0 * n + i * i, -float(i), 0)
        for n, (name, length) in enumerate(lengths.items(), start=1)
        for i in range(1, length + 1)
    ]


def uneven_series(seed=3):
    """One series with a third of all rows, gaps in the cycles, equal cycles and exact copies."""
    rng = random.Random(seed)
    rows = []
    for name, n in [("hot", 400), ("b", 61), ("c", 30), ("d", 7), ("e", 1), ("f", 301)]:
        cycle = 0
        for _ in range(n):
            cycle += rng.choice([0, 1, 1, 1, 2, 40]) if rng.random() < 0.9 else 500
            rows.append((1, cycle + 1, name, float(rng.randint(0, 9)), rng.random(), rng.randint(0, 2)))
    rows += [rows[i] for i in range(0, len(rows), 50)]
    rng.shuffle(rows)
    return rows


def brute_windows(rows, window):
    """(engine, end cycle, label, values) of every full window, from sorted Python lists."""
    series: dict[str, list] = {}
    for row in rows:
        series.setdefault(row[2], []).append(row)
    out = []
    for name, items in series.items():
        items.sort(key=lambda r: (r[1], r[3], r[4]))
        for end in range(window - 1, len(items)):
            frame = items[end - window + 1 : end + 1]
            values = tuple(float(np.float32(v)) for r in frame for v in (r[3], r[4]))
            out.append((name, items[end][1], items[end][5], values))
    return sorted(out)


def collected_windows(df):
    return sorted(
        (r["engine_id"], r["end_cycle"], r["failure_type"], tuple(v for row in r["readings"] for v in row))
        for r in df.collect()
    )


def write_fleet(path, lives, seed=0):
    """Text telemetry of engines that wear out: gauges saturate towards the end of life, each with its own
    gain, settings follow a duty cycle, and noise is a fraction of the gain. One line per reading."""
    rng = random.Random(seed)
    gains = [(-1) ** k * (2 + 0.7 * k) for k in range(21)]
    with path.open("w") as out:
        for unit, life in enumerate(lives, start=1):
            for cycle in range(1, life + 1):
                wear = 1 - math.exp(-3.0 * cycle / life)
                duty = [round(0.02 * math.sin(cycle / 7 + k), 4) for k in range(3)]
                gauges = [round(80 + 9 * k + g * (wear + rng.uniform(-0.05, 0.05)), 4) for k, g in enumerate(gains)]
                out.write(" ".join(map(str, [unit, cycle, *duty, *gauges])) + "\n")
