"""Session settings and shared scratch storage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Engine-level or report-level tables with at most this many rows are broadcast.
BROADCAST_ROWS = 200_000
# Rows that a task of a keyed step is dealt, so that what it sorts does not grow with the table.
ROWS_PER_TASK = 250_000


def local_session(cores: str = "*", app: str = "wearspan", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    Taken from the session. Only a local-mode session without one gets a temporary folder; on a
    cluster a missing setting is an error, because executors do not share a machine's disk.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
            configured = tempfile.mkdtemp(prefix="wearspan-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write once to the shared folder, in folders by the values of `by`, and read back: cuts lineage and keeps column pruning."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers, once per application, as a zip that the driver serves."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    path = os.path.join(tempfile.mkdtemp(prefix="wearspan-"), "wearspan_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a keyed step over `rows` rows: the configured number, or more where that would deal a task more than
    `spark.wearspan.rowsPerTask` (250,000) rows."""
    share = int(spark.conf.get("spark.wearspan.rowsPerTask", str(ROWS_PER_TASK)))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // share))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Deal `rows` counted rows out by their keys to as many partitions as they need.

    Where the configured number does, nothing is planned here: the exchange of the step that follows is as good.
    """
    spark = df.sparkSession
    wanted = tasks_for(spark, rows)
    return df.repartition(wanted, *keys) if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def attach(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join a written one-row-per-key table to many rows.

    The table is counted first (cheap on a written table). Up to `BROADCAST_ROWS` rows it is
    broadcast; beyond that Spark joins by shuffle, where AQE splits a hot key.
    """
    if table.count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    return rows.join(table, key, how)
