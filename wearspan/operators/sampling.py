"""Seeded picks and splits of whole engines.

Picks are ranks by `md5(seed|engine)`: reproducible in any engine and independent of partitioning.
Only the engine table is ranked; rows meet the result through a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearspan.functions.digests import seeded_digest
from wearspan.operators.ordinals import digest_rank
from wearspan.schemas import ENTITY
from wearspan.session import attach, written

SPLITS = ("train", "val", "test")


def engine_table(df: DataFrame) -> DataFrame:
    """Distinct (sub-dataset, engine) pairs."""
    return df.select("dataset_id", ENTITY).distinct()


def selected_engines(df: DataFrame, max_engines: int, seed: int) -> DataFrame:
    """Engines kept by `select_engines`, with their rank inside the sub-dataset."""
    engines = engine_table(df)
    sizes = engines.agg(
        F.count(F.lit(1)).alias("engines"), F.countDistinct("dataset_id").alias("datasets")
    )
    total = sizes.select("engines").scalar()
    quota = F.greatest(
        F.lit(1),
        sizes.select(
            F.expr(f"{int(max_engines)} div greatest(datasets, 1)")
        ).scalar(),
    )
    ranked = digest_rank(engines, seeded_digest(seed, F.col(ENTITY)), ENTITY, ["dataset_id"], "pick")
    return ranked.filter((total <= max_engines) | (F.col("pick") <= quota))


def select_engines(df: DataFrame, max_engines: int | None, seed: int = 42) -> DataFrame:
    """Keep whole engines, the same quota per sub-dataset.

    The quota is `max(1, max_engines // sub-datasets)`, capped at what a sub-dataset has and not
    redistributed. No limit, zero or a negative limit keeps everything.
    """
    if not max_engines or max_engines <= 0:
        return df
    kept = selected_engines(df, max_engines, seed).select(ENTITY)
    # One engine per sub-dataset at least, so the kept set has no bound of its own: it is written and counted.
    return attach(df, written(kept, "kept"), ENTITY, "left_semi")


def check_fractions(val_split: float, test_split: float) -> None:
    if not (0 < val_split < 1 and 0 < test_split < 1 and val_split + test_split < 1):
        raise ValueError(
            f"val_split {val_split} and test_split {test_split} must lie in (0, 1) and sum to less than 1"
        )


def _ceil_share(fraction: float, count: Column) -> Column:
    # A double product, so that the size equals ceil() of the same IEEE expression elsewhere.
    return F.ceil(F.lit(float(fraction)) * count.cast("double"))


def split_three_ways(
    engines: DataFrame,
    val_split: float = 0.2,
    test_split: float = 0.2,
    seed: int = 42,
    key: str = ENTITY,
) -> DataFrame:
    """(engine, split) with every engine in exactly one of train, val and test.

    Both fractions are shares of all engines; the validation share is rescaled to what is left
    after the test engines. With fewer than three engines each split is the full set.
    """
    check_fractions(val_split, test_split)
    distinct = engines.select(key).distinct()
    count = distinct.agg(F.count(F.lit(1))).scalar()
    ranked = digest_rank(distinct, seeded_digest(seed, F.col(key)), key, [], "_rank").withColumn(
        "_n", count
    )
    test = _ceil_share(test_split, F.col("_n"))
    val = _ceil_share(val_split / (1 - test_split), F.col("_n") - F.col("_test"))
    split = (
        F.when(F.col("_rank") <= F.col("_test"), "test")
        .when(F.col("_rank") <= F.col("_test") + F.col("_val"), "val")
        .otherwise("train")
    )
    everything = F.array(*[F.lit(s) for s in SPLITS])
    return (
        ranked.withColumn("_test", test)
        .withColumn("_val", val)
        .withColumn("split", F.explode(F.when(F.col("_n") < 3, everything).otherwise(F.array(split))))
        .select(key, "split")
    )


@dataclass(frozen=True)
class SplitRule:
    """A three-way split as two digest cutoffs.

    Ranks by digest are thresholds on the digest, so a row finds its split from its own engine id:
    wide rows need neither a join nor a shuffle, however many engines there are. Without cutoffs
    every split is the full set.
    """

    seed: int
    cutoffs: tuple[str, str] | None

    def column(self, engine: Column) -> Column:
        test, val = self.cutoffs
        digest = seeded_digest(self.seed, engine)
        return F.when(digest <= test, "test").when(digest <= val, "val").otherwise("train")

    def assigned(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows with their `split`; one copy per split when there are no cutoffs."""
        if self.cutoffs is None:
            return rows.withColumn("split", F.explode(F.array(*[F.lit(s) for s in SPLITS])))
        return rows.withColumn("split", self.column(F.col(key)))

    def part(self, rows: DataFrame, key: str, split: str) -> DataFrame:
        if self.cutoffs is None:
            return rows
        return rows.filter(self.column(F.col(key)) == split)


def split_rule(
    engines: DataFrame,
    val_split: float = 0.2,
    test_split: float = 0.2,
    seed: int = 42,
    key: str = ENTITY,
) -> SplitRule:
    """The split of `split_three_ways` as a rule; two digests come back to the driver."""
    check_fractions(val_split, test_split)
    distinct = engines.select(key).distinct()
    n = distinct.count()
    if n < 3:
        return SplitRule(seed, None)
    test = math.ceil(test_split * n)
    val = math.ceil(val_split / (1 - test_split) * (n - test))
    digest = seeded_digest(seed, F.col(key))
    ranked = digest_rank(distinct, digest, key, [], "_rank")
    edges = ranked.filter(F.col("_rank").isin(test, test + val)).select("_rank", digest.alias("d"))
    found = {r["_rank"]: r["d"] for r in edges.collect()}
    return SplitRule(seed, (found[test], found[test + val]))


def split_two_ways(
    engines: DataFrame, val_split: float = 0.2, seed: int = 42, key: str = ENTITY
) -> DataFrame:
    """(engine, split) with train and val; one engine alone is both."""
    if not 0 < val_split < 1:
        raise ValueError(f"val_split {val_split} must lie in (0, 1)")
    distinct = engines.select(key).distinct()
    count = distinct.agg(F.count(F.lit(1))).scalar()
    ranked = digest_rank(distinct, seeded_digest(seed, F.col(key)), key, [], "_rank").withColumn(
        "_n", count
    )
    split = F.when(F.col("_rank") <= _ceil_share(val_split, F.col("_n")), "val").otherwise("train")
    both = F.array(F.lit("train"), F.lit("val"))
    return ranked.withColumn(
        "split", F.explode(F.when(F.col("_n") < 2, both).otherwise(F.array(split)))
    ).select(key, "split")


def split_sizes(windows: DataFrame, key: str = "engine_id") -> DataFrame:
    """Rows and engines per split."""
    return windows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("engines")
    )


def split_leaks(assignment: DataFrame, engines: DataFrame, key: str = ENTITY) -> DataFrame:
    """One row: engines in more than one split, and engines without a split. Both should be 0."""
    placed = assignment.groupBy(key).agg(F.countDistinct("split").alias("splits"))
    joined = engines.select(key).distinct().join(placed, key, "left")
    return joined.agg(
        F.count_if(F.col("splits") > 1).alias("shared_engines"),
        F.count_if(F.col("splits").isNull()).alias("unplaced_engines"),
    )
