from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from wearspan.functions.digests import seeded_digest
from wearspan.operators.ordinals import digest_rank
from wearspan.operators.sampling import (
    select_engines,
    split_leaks,
    split_rule,
    split_three_ways,
    split_two_ways,
)


def fleet(spark, engines=10, datasets=4):
    rows = [
        (u, c, f"FD00{d}", f"FD00{d}_{u}")
        for d in range(1, datasets + 1)
        for u in range(1, engines + 1)
        for c in range(1, 4)
    ]
    return spark.createDataFrame(
        rows, "unit_number long, time_in_cycles long, dataset_id string, global_unit string"
    )


def engines(spark, n):
    return spark.range(n).select(F.concat(F.lit("E"), "id").alias("global_unit"))


def test_whole_engines_with_the_same_quota(spark):
    picked = select_engines(fleet(spark), 8, 42)
    assert {r["dataset_id"]: r["n"] for r in picked.groupBy("dataset_id").agg(F.countDistinct("global_unit").alias("n")).collect()} == {
        f"FD00{d}": 2 for d in range(1, 5)
    }
    assert {r["count"] for r in picked.groupBy("global_unit").count().collect()} == {3}


def test_picks_repeat_and_depend_on_the_seed(spark):
    def names(seed, parts):
        rows = select_engines(fleet(spark).repartition(parts), 8, seed).select("global_unit")
        return {r[0] for r in rows.distinct().collect()}

    assert names(1, 2) == names(1, 9)
    assert names(1, 2) != names(2, 2)


@pytest.mark.parametrize("limit", [None, 0, -3, 40, 99])
def test_no_limit_or_a_high_one_keeps_everything(spark, limit):
    assert select_engines(fleet(spark), limit).count() == 120


def test_quota_overshoots_and_is_not_redistributed(spark):
    assert select_engines(fleet(spark), 2).select("global_unit").distinct().count() == 4
    uneven = fleet(spark, 10, 1).unionByName(fleet(spark, 1, 2).filter("dataset_id = 'FD002'"))
    assert select_engines(uneven, 8).select("global_unit").distinct().count() == 5


def test_three_way_split_sizes(spark):
    split = split_three_ways(engines(spark, 20))
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 12,
        "val": 4,
        "test": 4,
    }
    leaks = split_leaks(split, engines(spark, 20)).first()
    assert (leaks["shared_engines"], leaks["unplaced_engines"]) == (0, 0)


def test_published_split_sizes(spark):
    split = split_three_ways(engines(spark, 709))
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"test": 142, "val": 142, "train": 425}


@pytest.mark.parametrize("n", [1, 2])
def test_too_few_engines_give_three_full_copies(spark, n):
    split = split_three_ways(engines(spark, n))
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == dict.fromkeys(
        ("train", "val", "test"), n
    )


@pytest.mark.parametrize(("val", "test"), [(0.5, 0.5), (0, 0.2), (0.2, 0), (1.0, 0.2), (-0.1, 0.2), (0.7, 0.6)])
def test_bad_fractions_are_refused(spark, val, test):
    with pytest.raises(ValueError, match="must lie in"):
        split_three_ways(engines(spark, 10), val, test)


def test_two_way_split(spark):
    split = split_two_ways(engines(spark, 20), 0.25)
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 15,
        "val": 5,
    }
    alone = split_two_ways(engines(spark, 1))
    assert sorted(r["split"] for r in alone.collect()) == ["train", "val"]


def test_digest_rank_equals_a_global_sort(spark):
    import hashlib

    df = spark.range(3000).select((F.col("id") % 3).alias("s"), F.col("id").cast("string").alias("k"))
    got = digest_rank(df, seeded_digest(5, F.col("k")), "k", ["s"], "r").collect()
    for stratum in range(3):
        keys = sorted(
            (str(i) for i in range(3000) if i % 3 == stratum),
            key=lambda k: hashlib.md5(f"5|{k}".encode()).hexdigest(),
        )
        assert {r["k"]: r["r"] for r in got if r["s"] == stratum} == {
            k: i + 1 for i, k in enumerate(keys)
        }


@pytest.mark.parametrize("n", [1, 2, 3, 20, 333])
def test_split_rule_equals_the_split_table(spark, n):
    table = split_three_ways(engines(spark, n), 0.3, 0.25, 9)
    rule = split_rule(engines(spark, n), 0.3, 0.25, 9)
    by_rule = rule.assigned(engines(spark, n), "global_unit")
    assert sorted(map(tuple, by_rule.collect())) == sorted(map(tuple, table.collect()))
    for split in ("train", "val", "test"):
        part = rule.part(engines(spark, n), "global_unit", split)
        assert part.count() == table.filter(F.col("split") == split).count()
    assert "Exchange" not in by_rule._jdf.queryExecution().executedPlan().toString()
