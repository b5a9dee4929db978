"""Registered queries over the given tables, each with an equivalent SQL text where SQL can say it."""

from wearspan.queries import (  # noqa: F401
    aggregates,
    arrays,
    checks,
    datasets,
    projections,
    runs,
    scoring,
    series,
    sources,
    streams,
    training,
)
from wearspan.queries.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
