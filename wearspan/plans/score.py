"""Batch scoring with the champion."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearspan.operators.linear import of_regression, score_window_table
from wearspan.operators.scoring import accepted_and_rejected, request_columns, responses, score_windows
from wearspan.sources.ledger import Champion, Ledger

FLAT = "_flat"


@dataclass(frozen=True)
class Scored:
    answers: DataFrame
    rejected: DataFrame


def score_requests(requests: DataFrame, champion: Champion) -> Scored:
    """Refuse what breaks the request contract or the model's shape; answer the rest.

    Readings are double here and narrowed after scaling.
    """
    good, bad = accepted_and_rejected(requests, champion.window_size, champion.num_features)
    flat = good.withColumn(FLAT, F.flatten("readings"))
    scored = score_windows(flat, champion.model, champion.scaler, FLAT)
    rejected = bad.select(*request_columns(requests), "reasons")
    return Scored(responses(scored, champion.version), rejected)


def score_table(windows: DataFrame, champion: Champion) -> DataFrame:
    """Answers for a window table whose shape is checked once, by its contract."""
    rows = windows.select("engine_id", "windowed_features")
    return responses(score_window_table(rows, of_regression(champion.model), champion.scaler), champion.version)


def score(requests: DataFrame, ledger: Ledger, model_name: str, default_window: int) -> Scored:
    """Resolve the champion once and score with that version only."""
    return score_requests(requests, ledger.champion(model_name, default_window))


