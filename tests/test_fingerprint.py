"""Content fingerprints: exact bits, rolled row digests, rows and window tables alike."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from helpers import CLEAN, uneven_series
from pyspark.sql import functions as F

from wearspan.functions.digests import float_bits
from wearspan.operators.lineage import (
    LONGEST_WINDOW,
    contents_of_series,
    digests_of_series,
    digests_of_windows,
    fingerprint,
)
from wearspan.operators.ranked import LongSeries, find_long_series
from wearspan.operators.blocks import SplitPolicy
from wearspan.operators.windows import indexed_windows
from wearspan.queries import QUERIES
from wearspan.queries.catalog import VARYING
from wearspan.sources.bindings import labeled

FEATURES = ["sensor_1", "sensor_2"]


def patterns():
    rng = np.random.default_rng(4)
    edges = [0, 1, 2, 2**22, 2**23 - 1, 2**23, 2**23 + 1, 254 * 2**23, 255 * 2**23 - 1, 255 * 2**23]
    powers = [e * 2**23 + d for e in range(1, 255) for d in (-1, 0, 1)]
    some = rng.integers(0, 255 * 2**23, 2000).tolist()
    return [p + sign for p in edges + powers + some for sign in (0, 2**31)]


def test_bits_are_those_of_the_float(spark):
    wanted = np.array(patterns(), dtype=np.uint32)
    values = [(int(b), float(v)) for b, v in zip(wanted, wanted.view(np.float32), strict=True)]
    rows = spark.createDataFrame(values, "bits long, value float")
    assert rows.filter(float_bits(F.col("value")) != F.col("bits")).collect() == []
    odd = spark.createDataFrame([(math.nan,), (None,)], "value double")
    assert [r[0] for r in odd.select(float_bits(F.col("value"))).collect()] == [0x7FC00000, None]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(rows, window):
    """(engine, position, digest) of every window, by Python's own hashes and float patterns."""
    series: dict[str, list] = {}
    for r in rows:
        series.setdefault(r[2], []).append(r)
    out = []
    for name, items in series.items():
        items.sort(key=lambda r: (r[1], r[3], r[4]))
        limbs = []
        for i, r in enumerate(items, start=1):
            bits = ",".join(str(int(np.float32(v).view(np.uint32))) for v in (r[3], r[4]))
            d = sha(f"{i}|{bits}")
            limbs.append([int(d[12 * k : 12 * k + 12], 16) for k in range(5)])
        for first in range(len(items) - window + 1):
            sums = [sum(x[k] for x in limbs[first : first + window]) for k in range(5)]
            out.append((name, first, sha("|".join(map(str, [first, items[first + window - 1][5], *sums, name])))))
    return sorted(out)


@pytest.mark.parametrize("window", [1, 7, 90])
@pytest.mark.parametrize("limit", [40, 10**6])
def test_digests_of_a_series_equal_plain_python(spark, window, limit):
    # One label per key, because rows of equal keys may come in either order.
    rows = [(*r[:5], int(r[4] * 3)) for r in uneven_series()]
    df = spark.createDataFrame(rows, CLEAN).repartition(3)
    long = find_long_series(df, "global_unit", "time_in_cycles", SplitPolicy(rows_per_block=limit))
    got = digests_of_series(df, FEATURES, window, long)
    assert sorted((r["engine_id"], r["window_index"], r["_d"]) for r in got.collect()) == plain_digests(rows, window)


def test_window_tables_have_the_digests_of_their_rows(spark):
    df = spark.createDataFrame([(*r[:5], int(r[4] * 3)) for r in uneven_series()], CLEAN)
    table = indexed_windows(df, 7, FEATURES).withColumn("windowed_features", F.flatten("readings"))
    columns = ["engine_id", "window_index", "failure_type", "_d"]
    from_table = digests_of_windows(table, 2).select(*columns)
    from_rows = digests_of_series(df, FEATURES, 7).select(*columns)
    assert from_rows.count() == from_table.count() > 500
    assert from_rows.exceptAll(from_table).count() == 0
    prints = [fingerprint(d, FEATURES, 0.2, 0.2, 42).first() for d in (from_rows, from_table)]
    assert prints[0] == prints[1]
    assert fingerprint(from_rows, FEATURES, 0.2, 0.2, 43).first()["fingerprint"] != prints[0]["fingerprint"]


def test_one_unit_in_the_last_place_and_any_exchange_change_it(spark):
    rows = [(1, i, "a", 100.0 + i, 0.25, 0) for i in range(1, 41)]

    def print_of(changed):
        digests = digests_of_series(spark.createDataFrame(changed, CLEAN), FEATURES, 5, LongSeries(None))
        return fingerprint(digests, FEATURES, 0.2, 0.2, 42).first()["fingerprint"]

    first = print_of(rows)
    assert print_of(rows[::-1]) == first
    nudged = float(np.nextafter(np.float32(rows[20][3]), np.float32(1e9)))
    zeros = [(*r[:4], 0.0, 0) for r in rows]
    others = [
        [*rows[:20], (*rows[20][:3], nudged, 0.25, 0), *rows[21:]],
        [*rows[:20], (*rows[20][:5], 1), *rows[21:]],
        [*rows[:20], (1, 21, "a", rows[21][3], 0.25, 0), (1, 22, "a", rows[20][3], 0.25, 0), *rows[22:]],
        [*rows[:20], (*rows[20][:3], None, 0.25, 0), *rows[21:]],
        [(*r[:2], "b", *r[3:]) for r in rows],
        rows[1:],
        zeros,
        [(*zeros[0][:4], -0.0, 0), *zeros[1:]],
    ]
    assert len({first, *map(print_of, others)}) == len(others) + 1


def test_windows_that_no_integer_holds_are_refused(spark):
    with pytest.raises(ValueError, match="window must lie"):
        digests_of_series(spark.createDataFrame([], CLEAN), FEATURES, LONGEST_WINDOW + 1)


def test_one_shuffle_and_no_collected_frames(spark):
    df = spark.createDataFrame(uneven_series(), CLEAN)
    plan = digests_of_series(df, FEATURES, 30, LongSeries(None))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "collect_list" not in plan


def whole_digests(rows, window):
    """(engine, position, digest) of every window: the bits of all its values are hashed again for each window."""
    series: dict[str, list] = {}
    for r in rows:
        series.setdefault(r[2], []).append(r)
    out = []
    for name, items in series.items():
        items.sort(key=lambda r: (r[1], *r[3:-1]))
        bits = [[str(int(np.float32(v).view(np.uint32))) for v in r[3:-1]] for r in items]
        for first in range(len(items) - window + 1):
            values = ",".join(b for row in bits[first : first + window] for b in row)
            out.append((name, first, sha(f"{first}|{items[first + window - 1][-1]}|{values}|{name}")))
    return sorted(out)


@pytest.mark.parametrize("window", [1, 7, 90])
@pytest.mark.parametrize("limit", [40, 10**6])
def test_contents_of_a_series_hash_every_window_whole(spark, window, limit):
    rows = [(*r[:5], int(r[4] * 3)) for r in uneven_series()]
    df = spark.createDataFrame(rows, CLEAN).repartition(3)
    long = find_long_series(df, "global_unit", "time_in_cycles", SplitPolicy(rows_per_block=limit))
    got = contents_of_series(df, FEATURES, window, long)
    assert sorted((r["engine_id"], r["window_index"], r["_d"]) for r in got.collect()) == whole_digests(rows, window)


def test_the_queries_hash_all_values_of_every_window(spark, small_dir):
    columns = ["unit_number", "time_in_cycles", "global_unit", *VARYING, "failure_type"]
    digests = whole_digests([tuple(r) for r in labeled(spark, small_dir).select(*columns).collect()], 30)
    engines: dict[str, list] = {}
    for name, _, digest in digests:
        engines.setdefault(name, []).append(digest)

    def total(found):
        limbs = [sum(int(d[15 * k : 15 * k + 15], 16) for d in found) for k in range(4)]
        return sha("|".join(map(str, [len(found), *limbs])))

    got = {r["engine_id"]: (r["rows"], r["digest"]) for r in QUERIES["agg_16_engine_digests"](spark, small_dir).collect()}
    assert got == {name: (len(found), total(found)) for name, found in engines.items()}
    print_of_all = sha(total([d for _, _, d in digests]) + "|val=200000;test=200000;seed=42;" + ",".join(VARYING))
    assert QUERIES["agg_16_fingerprint"](spark, small_dir).first()["fingerprint"] == print_of_all
