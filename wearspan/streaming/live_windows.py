"""Sliding windows and deduplication over a live feed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wearspan.schemas import CYCLE, ENTITY
from wearspan.streaming.seen import DIGEST, WHEN, SeenDigests

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def window_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField(ENTITY, T.StringType()),
            T.StructField("end_cycle", T.LongType()),
            T.StructField("late", T.BooleanType()),
            T.StructField("windowed_features", T.ArrayType(T.FloatType())),
        ]
    )


class LastRows(StatefulProcessor):
    """Keeps the last `window - 1` rows of one engine and emits full windows.

    Rows are ordered inside a micro-batch. A row at or before the last cycle already processed is
    late: it is returned marked, with its own values, and does not enter the state. State is
    bounded by the window; how many rows one call sees is bounded by the source's batch size.
    """

    def __init__(self, window: int, features: list[str]) -> None:
        self.window = window
        self.features = features

    def init(self, handle: StatefulProcessorHandle) -> None:
        row = T.StructType(
            [
                T.StructField("cycle", T.LongType()),
                T.StructField("values", T.ArrayType(T.FloatType())),
            ]
        )
        self.rows = handle.getListState("rows", row)
        self.last = handle.getValueState("last", T.StructType([T.StructField("cycle", T.LongType())]))

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values([CYCLE, *self.features], kind="stable")
        seen = self.last.get()[0] if self.last.exists() else None
        late = batch[CYCLE] <= seen if seen is not None else pd.Series(False, index=batch.index)
        fresh = batch[~late.to_numpy()]
        values = fresh[self.features].to_numpy(dtype="float32")
        history = [(cycle, list(old)) for cycle, old in self.rows.get()] if self.rows.exists() else []
        held = history + [
            (int(c), [float(x) for x in v]) for c, v in zip(fresh[CYCLE], values, strict=True)
        ]
        ends = range(max(self.window - 1, len(history)), len(held))
        out = [
            {
                ENTITY: key[0],
                "end_cycle": held[end][0],
                "late": False,
                "windowed_features": [x for _, v in held[end - self.window + 1 : end + 1] for x in v],
            }
            for end in ends
        ]
        out += [
            {
                ENTITY: key[0],
                "end_cycle": int(cycle),
                "late": True,
                "windowed_features": [float(x) for x in row],
            }
            for cycle, row in zip(
                batch[late.to_numpy()][CYCLE],
                batch[late.to_numpy()][self.features].to_numpy(dtype="float32"),
                strict=True,
            )
        ]
        if len(fresh):
            self.last.update((held[-1][0],))
            keep = held[-(self.window - 1) :] if self.window > 1 else []
            if keep:
                self.rows.put(keep)
        if out:
            yield pd.DataFrame(out, columns=[ENTITY, "end_cycle", "late", "windowed_features"])

    def close(self) -> None:
        pass


def live_windows(feed: DataFrame, window: int, features: list[str]) -> DataFrame:
    """Count-based last-`window` frames per engine over a stream.

    Needs `spark.sql.streaming.stateStore.providerClass` set to the RocksDB provider.
    """
    return feed.select(ENTITY, CYCLE, *features).groupBy(ENTITY).transformWithStateInPandas(
        LastRows(window, features), window_schema(), "append", "none"
    )


# Rows as JSON with every microsecond of their timestamps, nested ones too; by default it is cut to milliseconds.
EXACT = {
    "ignoreNullFields": "false",
    "timestampFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def start_distinct(
    feed: DataFrame,
    folder: str,
    event_time: str,
    lateness: str,
    checkpoint: str,
    columns: list[str] | None = None,
    **trigger,
) -> StreamingQuery:
    """Splits a feed into `kept`, `late` and counted duplicates; every row goes to exactly one of them.

    Rows are equal if all their columns are (or `columns`, if given). A row more than `lateness` behind the
    newest event of earlier batches is late: it is written to `late` as it came, and nobody judges
    whether it was seen before. Any other row is kept once, against the digests of all kept rows that
    young; older digests are removed. Rows that are equal by `columns` are remembered by the newest event time that
    a batch has of them. A batch writes folders of its own, so a replay overwrites itself. Rows without event time
    are never late.
    """

    def split(rows: DataFrame, batch: int) -> None:
        seen = SeenDigests(rows.sparkSession, f"{folder}/seen", lateness)
        keys = columns or rows.columns
        marked = rows.withColumn(DIGEST, F.sha2(F.to_json(F.struct(*keys), EXACT), 256))
        marked = marked.withColumn(WHEN, F.unix_micros(F.col(event_time).cast("timestamp"))).persist()
        border = seen.border(batch)
        is_late = F.coalesce(F.col(WHEN) < F.lit(border).cast("long"), F.lit(False))
        fresh = marked.where(~is_late)
        digests = fresh.groupBy(DIGEST).agg(F.max(WHEN).alias(WHEN))
        seen.add(digests.join(seen.young(batch, border).select(DIGEST), DIGEST, "left_anti"), batch)
        held = seen.of(batch)
        chosen = fresh.dropDuplicates([DIGEST]).join(held, DIGEST, "left_semi")
        _batch(chosen.select(*rows.columns), f"{folder}/kept", batch)
        _batch(marked.where(is_late).select(*rows.columns), f"{folder}/late", batch)
        counts = marked.agg(F.count(F.lit(1)).alias("received"), F.count_if(is_late).alias("late"))
        counts = counts.withColumn("kept", F.lit(held.count()))
        _batch(counts.withColumn("duplicates", F.col("received") - F.col("late") - F.col("kept")), f"{folder}/counts", batch)
        seen.advance(batch, marked)
        seen.forget(border)
        marked.unpersist()

    return (
        feed.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _batch(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what is available now into parquet and return the result."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def late_rows(windows: DataFrame) -> DataFrame:
    return windows.filter(F.col("late"))
