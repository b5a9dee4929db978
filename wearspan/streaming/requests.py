"""Request streams: contract, quarantine and scoring."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import suppress
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wearspan.operators.contracts import VIOLATIONS
from wearspan.operators.scoring import checked_requests, request_columns
from wearspan.plans.score import score_requests
from wearspan.schemas import DECISIONS
from wearspan.sources.ledger import Champion


@dataclass(frozen=True)
class DecisionLog:
    """Which version answers a micro-batch, one folder per batch id; keep it beside the stream's checkpoint.

    A decision is written before its batch is scored. A folder whose write was cut short holds no row and thus no decision.
    """

    spark: SparkSession
    root: str

    def read(self, batch: int) -> Row | None:
        """(model_name, version, run_id), all NULL for a batch that had no champion; None if nothing was decided."""
        try:
            return self.spark.read.schema(DECISIONS).parquet(f"{self.root}/batch={batch}").first()
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
                raise
            return None

    def write(self, batch: int, champion: Champion | None) -> None:
        row = (None,) * 3 if champion is None else (champion.model_name, champion.version, champion.run_id)
        self.spark.createDataFrame([row], DECISIONS).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")


@dataclass
class BatchChampion:
    """Which champion answers a micro-batch; decided once per batch, at its border.

    `look_up` asks the promotions for the champion of the day and may fail. It is asked at the first border,
    and again at borders at least `every_seconds` after the last time it was asked: while there is no
    champion, or always if promotions are followed. A failed look-up changes nothing. A batch
    that is replayed gets the decision it had, so its answers do not mix versions: within a process always, after a
    restart with a `log`, whose versions `recall` loads. A version that cannot be loaded again fails the batch.
    """

    look_up: Callable[[], Champion]
    every_seconds: float = 30.0
    follow_promotions: bool = False
    clock: Callable[[], float] = time.monotonic
    decision: tuple[int, Champion | None] = (-1, None)
    asked_at: float | None = None
    log: DecisionLog | None = None
    recall: Callable[[str, str, str], Champion] | None = None

    def __post_init__(self) -> None:
        if (self.log is None) != (self.recall is None):
            raise ValueError("a decision log needs a way to recall a version, and the other way round")

    def of(self, batch: int) -> Champion | None:
        decided_for, champion = self.decision
        if batch == decided_for:
            return champion
        logged = self.log.read(batch) if self.log else None
        if logged is not None:
            champion = None if logged["run_id"] is None else self.recall(*logged)
        else:
            rested = self.asked_at is None or self.clock() >= self.asked_at + self.every_seconds
            if rested and (champion is None or self.follow_promotions):
                self.asked_at = self.clock()
                with suppress(Exception):  # any failure means "not yet"
                    champion = self.look_up()
            if self.log:
                self.log.write(batch, champion)
        self.decision = (batch, champion)
        return champion


def _append(rows: DataFrame, path: str, batch: int) -> None:
    """One folder per batch: a replayed batch overwrites itself instead of adding rows twice."""
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def start_quarantine(
    requests: DataFrame, accepted: str, rejected: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Split a request stream by its contract into two sinks. Stateless. Malformed text is kept whole."""

    def split(rows: DataFrame, batch: int) -> None:
        checked = checked_requests(rows)
        _append(checked.good().select("engine_id", "readings"), accepted, batch)
        reasons = checked.bad().withColumn("reasons", F.array_join(VIOLATIONS, ","))
        _append(reasons.select(*request_columns(rows), "reasons"), rejected, batch)

    return (
        requests.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_scoring(
    requests: DataFrame,
    champions: BatchChampion,
    answers: str,
    rejected: str,
    pending: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Score a request stream. Without a champion a batch goes to `pending` whole and unanswered."""

    def score(rows: DataFrame, batch: int) -> None:
        champion = champions.of(batch)
        if champion is None:
            _append(rows.select(*request_columns(rows)), pending, batch)
            return
        scored = score_requests(rows, champion)
        _append(scored.answers, answers, batch)
        _append(scored.rejected, rejected, batch)

    return (
        requests.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
