"""Declarative data contracts checked in one pass.

A contract is a list of fields, each with a type and named `Column -> Column` predicates. Every
failure is found before anything is raised. Contracts are open: extra columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F

from wearspan.functions.arrays import first_row_failing, has_shape, is_finite, is_rectangular
from wearspan.schemas import CYCLE, ENTITY, LABEL

VIOLATIONS = "violations"


class ContractError(ValueError):
    """A broken contract; `counts` maps a check to its number of failing rows."""

    def __init__(self, contract: str, counts: dict[str, int]) -> None:
        self.contract = contract
        self.counts = counts
        listed = ", ".join(f"{name}: {n}" for name, n in sorted(counts.items()))
        super().__init__(f"contract {contract} broken - {listed}")


@dataclass(frozen=True)
class Check:
    name: str
    good: Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """A required column, or with `family` a required group of columns matching a pattern.

    `dtype` is a Spark type name; a tuple accepts any of several; None accepts any type.
    """

    name: str
    dtype: str | tuple[str, ...] | None = None
    checks: tuple[Check, ...] = ()
    family: bool = False
    nullable: bool = False

    def columns(self, available: list[str]) -> list[str]:
        if self.family:
            return [c for c in available if re.fullmatch(self.name, c)]
        return [c for c in available if c == self.name]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    coerce: bool = False
    row_checks: tuple[tuple[str, Callable[[], Column]], ...] = field(default=())

    def extended(self, name: str, *fields: Field) -> Contract:
        return Contract(name, self.fields + fields, self.coerce, self.row_checks)

    def with_row_check(self, name: str, good: Callable[[], Column]) -> Contract:
        return Contract(self.name, self.fields, self.coerce, self.row_checks + ((name, good),))


def greater_than(limit: float) -> Check:
    return Check(f"greater_than_{limit}", lambda c: c > limit)


def at_least(limit: float) -> Check:
    return Check(f"at_least_{limit}", lambda c: c >= limit)


def one_of(*values: int) -> Check:
    return Check("one_of_" + "_".join(map(str, values)), lambda c: c.isin(*values))


def magnitude_below(limit: float) -> Check:
    return Check("magnitude", lambda c: F.abs(c) < F.lit(limit))


def text_length(low: int, high: int | None = None) -> Check:
    def good(c: Column) -> Column:
        size = F.length(c)
        return size >= low if high is None else (size >= low) & (size <= high)

    return Check("length", good)


def not_blank() -> Check:
    return Check("not_blank", lambda c: F.regexp_replace(c, r"^\s+|\s+$", "") != "")


def custom(name: str, good: Callable[[Column], Column]) -> Check:
    """A caller's own predicate."""
    return Check(name, good)


# Bounds and column families of the telemetry contracts.
READING_LIMIT = 1e6
CLASSES = (0, 1, 2)

RAW_TELEMETRY = Contract(
    "raw_telemetry",
    (
        Field("unit_number", "bigint", (greater_than(0),)),
        Field(CYCLE, "bigint", (greater_than(0),)),
        Field(r"op_setting_[1-3]", "double", (magnitude_below(READING_LIMIT),), family=True),
        Field(r"sensor_\d+", "double", (magnitude_below(READING_LIMIT),), family=True),
        Field("dataset_id", "string"),
        Field(ENTITY, "string"),
    ),
    coerce=True,
)

LABELED_TELEMETRY = RAW_TELEMETRY.extended(
    "labeled_telemetry",
    Field("RUL", "bigint", (at_least(0),)),
    Field(LABEL, "bigint", (one_of(*CLASSES),)),
)


def _window_length(expected: int) -> Callable[[], Column]:
    return lambda: F.size("windowed_features") == expected


def windowed_features(expected_length: int) -> Contract:
    """Rows about to be written: exact timestamp type and array length `window * features`."""
    return Contract(
        "windowed_features",
        (
            Field("engine_id", "string", (text_length(1),)),
            Field("event_timestamp", "timestamp_ntz"),
            Field("created_timestamp", "timestamp_ntz"),
            Field("windowed_features", ("array<float>",)),
            Field(LABEL, ("int", "bigint"), (one_of(*CLASSES),)),
        ),
        row_checks=(("windowed_features:length", _window_length(expected_length)),),
    )


def training_batch(expected_length: int) -> Contract:
    """Rows about to be trained on: any timestamp variant, no creation time needed."""
    return Contract(
        "training_batch",
        (
            Field("engine_id", "string", (text_length(1),)),
            Field("event_timestamp", ("timestamp", "timestamp_ntz")),
            Field("windowed_features", ("array<float>", "array<double>")),
            Field(LABEL, ("int", "bigint"), (one_of(*CLASSES),)),
        ),
        row_checks=(("windowed_features:length", _window_length(expected_length)),),
    )


SCORING_REQUEST = Contract(
    "scoring_request",
    (
        Field("engine_id", "string", (text_length(1, 64), not_blank())),
        Field(
            "readings",
            None,
            (
                custom("rectangular", is_rectangular),
                custom("finite", lambda m: F.forall(m, lambda row: F.forall(row, is_finite))),
            ),
        ),
    ),
)


def request_shape(rows: int | Column, width: int | Column) -> tuple[str, Callable[[], Column]]:
    """Row check against the loaded model's window and feature counts."""
    return "readings:shape", lambda: has_shape(F.col("readings"), rows, width)


def request_reason() -> Column:
    """Why a request is refused, NULL for a good one; names the first failing row."""
    matrix = F.col("readings")
    width = F.size(F.get(matrix, F.lit(0)))
    ragged = first_row_failing(matrix, lambda row: F.size(row) == width)
    infinite = first_row_failing(matrix, lambda row: F.forall(row, is_finite))
    engine = F.col("engine_id")
    return (
        F.when(engine.isNull() | (F.length(engine) < 1) | (F.length(engine) > 64), "engine_id length")
        .when(~not_blank().good(engine), "engine_id blank")
        .when(matrix.isNull() | (F.size(matrix) < 1), "readings missing")
        .when(F.coalesce(width, F.lit(0)) < 1, "readings row 0 empty")
        .when(ragged.isNotNull(), F.concat(F.lit("readings not rectangular at row "), ragged.cast("string")))
        .when(infinite.isNotNull(), F.concat(F.lit("readings not finite at row "), infinite.cast("string")))
    )


@dataclass(frozen=True)
class Checked:
    """A frame and the tests of a contract on it: names and predicates over its columns as they came.

    `rows` has coerced columns plus `violations`, an array of `column:check`. Counts come straight from the
    predicates and never build that array.
    """

    contract: Contract
    source: DataFrame
    tests: tuple[tuple[str, Column], ...]
    coerced: dict[str, Column]

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.tests)

    @property
    def rows(self) -> DataFrame:
        broken = F.array(*[F.when(~F.coalesce(good, F.lit(False)), F.lit(name)) for name, good in self.tests])
        return self._coerced(self.source.withColumn(VIOLATIONS, F.array_compact(broken)))

    def _coerced(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.coerced) if self.coerced else df

    def good(self) -> DataFrame:
        return self.rows.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)

    def bad(self) -> DataFrame:
        return self.rows.filter(F.size(VIOLATIONS) > 0)

    def failure_cases(self) -> DataFrame:
        """One row per failing (row, check)."""
        return self.bad().withColumn("check", F.explode(VIOLATIONS)).drop(VIOLATIONS)

    def failure_counts(self) -> DataFrame:
        """(check, rows) for broken checks, from one aggregate over the rows."""
        counts = self.source.agg(*self._failure_columns())
        entries = F.array(
            *[
                F.struct(F.lit(name).alias("check"), F.col(f"_c{i}").alias("rows"))
                for i, name in enumerate(self.names)
            ]
        )
        return counts.select(F.inline(entries)).filter(F.col("rows") > 0)

    def measure(self, *measures: Column) -> Row:
        """One pass over the columns as they came: the given aggregates and the failure counts."""
        return self.source.agg(*measures, *self._failure_columns()).first()

    def _failure_columns(self) -> list[Column]:
        return [
            F.count_if(~F.coalesce(good, F.lit(False))).alias(f"_c{i}")
            for i, (_, good) in enumerate(self.tests)
        ]

    def raise_for_counts(self, measured: Row | dict) -> None:
        counts = measured.asDict() if isinstance(measured, Row) else measured
        broken = {
            name: counts[f"_c{i}"] for i, name in enumerate(self.names) if counts.get(f"_c{i}")
        }
        if broken:
            raise ContractError(self.contract.name, broken)

    def observed(self) -> tuple[DataFrame, Observation]:
        """The rows with failure counts measured by whatever action runs on them next."""
        watch = Observation()
        return self._coerced(self.source.observe(watch, *self._failure_columns())), watch

    def raise_for(self, watch: Observation) -> None:
        self.raise_for_counts(watch.get)

    def enforce(self) -> DataFrame:
        """The rows, or a `ContractError` that lists every broken check with its row count."""
        self.raise_for_counts(self.measure())
        return self._coerced(self.source)


def check(df: DataFrame, contract: Contract) -> Checked:
    """Apply a contract. Missing columns and, without coercion, wrong types raise at once."""
    _check_columns(df, contract)
    types = dict(df.dtypes)
    coerced: dict[str, Column] = {}
    tests: list[tuple[str, Column]] = []
    for rule in contract.fields:
        for name in rule.columns(df.columns):
            column = F.col(f"`{name}`")
            if contract.coerce and isinstance(rule.dtype, str) and types[name] != rule.dtype:
                converted = _coerce(column, types[name], rule.dtype)
                if converted is not column:
                    tests.append((f"{name}:coerce", _is_null(column, types[name]) | converted.isNotNull()))
                    coerced[name] = converted
                    column = converted
                absent = _is_null(F.col(f"`{name}`"), types[name])
            else:
                absent = _is_null(column, types[name])
            if not rule.nullable:
                tests.append((f"{name}:not_null", ~absent))
            for item in rule.checks:
                # A missing value is reported as such, not once more per check.
                tests.append((f"{name}:{item.name}", absent | column.isNull() | F.coalesce(item.good(column), F.lit(False))))
    for name, good in contract.row_checks:
        tests.append((name, F.coalesce(good(), F.lit(False))))
    return Checked(contract, df, tuple(tests), coerced)


def _check_columns(df: DataFrame, contract: Contract) -> None:
    problems: dict[str, int] = {}
    types = dict(df.dtypes)
    for rule in contract.fields:
        found = rule.columns(df.columns)
        if not found:
            problems[f"{rule.name}:present"] = 1
        if contract.coerce or rule.dtype is None:
            continue
        accepted = (rule.dtype,) if isinstance(rule.dtype, str) else rule.dtype
        for name in found:
            if types[name] not in accepted:
                problems[f"{name}:type {types[name]}"] = 1
    if problems:
        raise ContractError(contract.name, problems)


def _is_null(column: Column, dtype: str) -> Column:
    return column.isNull() | F.isnan(column) if dtype in ("float", "double") else column.isNull()


def _coerce(column: Column, source: str, target: str) -> Column:
    if target == "bigint" and (source in ("float", "double") or source.startswith("decimal")):
        # A fractional or non-finite number is not an integer.
        whole = (F.floor(column) == column) & (F.abs(column) < F.lit(float(2**53)))
        return F.when(F.coalesce(whole, F.lit(False)), column.try_cast("bigint"))
    return column.try_cast(target)
