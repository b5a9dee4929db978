"""Digests of kept rows, by event time, forgotten once no row that young can come."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIGEST, WHEN = "_digest", "_event_time"
HELD = f"{DIGEST} string, {WHEN} long, bucket long, batch long"
BUCKETS_PER_DELAY = 8


@dataclass(frozen=True)
class SeenDigests:
    """Digests in folders by bucket of event time, then batch; event times are microseconds.

    A batch asks for the border of the batch before it, reads the buckets at and behind that border,
    and may remove the others: a replay of the batch asks for the same border, so what it needs stays.
    Thus a batch costs what is held for `lateness`, not what the stream has ever seen. Digests without event
    time are never forgotten, because rows without one are never late.
    """

    spark: SparkSession
    root: str
    lateness: str

    @property
    def width(self) -> int:
        """Microseconds of a bucket."""
        delay = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {self.lateness}"))
        return max(1_000_000, self.spark.range(1).select(delay).first()[0] // BUCKETS_PER_DELAY)

    def border(self, batch: int) -> int | None:
        """Event times below it are late in `batch`: `lateness` before the newest of all earlier batches."""
        if batch == 0:
            return None
        newest = F.timestamp_micros("newest") - F.expr(f"INTERVAL {self.lateness}")
        rows = self.spark.read.schema("newest long").parquet(f"{self.root}/newest/batch={batch - 1}")
        return rows.select(F.unix_micros(newest)).first()[0]

    def advance(self, batch: int, rows: DataFrame) -> None:
        """Writes the newest event time of `rows` and all batches before."""
        newest = rows.agg(F.max(WHEN).alias("newest"))
        if batch:
            before = self.spark.read.schema("newest long").parquet(f"{self.root}/newest/batch={batch - 1}")
            newest = newest.unionByName(before).agg(F.max("newest").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/newest/batch={batch}")

    def young(self, batch: int, border: int | None) -> DataFrame:
        """Digests that earlier batches kept and that are not behind the border."""
        held = self._held().where(F.col("batch") < batch)
        if border is None:
            return held
        near = F.col("bucket").isNull() | (F.col("bucket") >= border // self.width)
        return held.where(near & F.coalesce(F.col(WHEN) >= border, F.lit(True)))

    def add(self, kept: DataFrame, batch: int) -> None:
        """Holds (digest, event time) of a batch; written again it replaces itself."""
        bucket = F.floor(F.col(WHEN) / F.lit(self.width)).cast("long")
        placed = kept.select(DIGEST, WHEN, bucket.alias("bucket"), F.lit(batch).cast("long").alias("batch"))
        placed.hint("rebalance", "bucket").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(
            "bucket", "batch"
        ).parquet(f"{self.root}/digests")

    def of(self, batch: int) -> DataFrame:
        return self._held().where(F.col("batch") == batch).select(DIGEST)

    def forget(self, border: int | None) -> None:
        """Removes the buckets that end before the border."""
        if border is None:
            return
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/digests")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for entry in files.listStatus(path):
            name, _, number = entry.getPath().getName().partition("=")
            if name == "bucket" and number.lstrip("-").isdigit() and int(number) < border // self.width:
                files.delete(entry.getPath(), True)

    def _held(self) -> DataFrame:
        try:
            return self.spark.read.schema(HELD).parquet(f"{self.root}/digests")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return self.spark.createDataFrame([], HELD)
