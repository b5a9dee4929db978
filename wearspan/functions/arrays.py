"""Array expressions for windows and readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def float_vector(columns: list[str]) -> Column:
    """One float32 array per row; narrowing happens before windowing and scaling."""
    return F.array(*[F.col(c).cast("float") for c in columns])


def reshape(flat: Column, rows: int | Column, width: int | Column) -> Column:
    """Flat timestep-major array -> array of `rows` arrays of `width` values."""
    rows, width = _column(rows), _column(width)
    return F.transform(
        F.sequence(F.lit(0), rows - 1), lambda i: F.slice(flat, i * width + 1, width)
    )


def all_finite(values: Column) -> Column:
    return F.forall(values, is_finite)


def is_finite(value: Column) -> Column:
    """False for NULL, NaN and both infinities."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def is_rectangular(matrix: Column) -> Column:
    """At least one row, a non-empty first row, every row as wide as the first."""
    width = F.size(F.get(matrix, F.lit(0)))
    return F.coalesce(
        (F.size(matrix) > 0)
        & (width > 0)
        & F.forall(matrix, lambda row: F.coalesce(F.size(row) == width, F.lit(False))),
        F.lit(False),
    )


def has_shape(matrix: Column, rows: int | Column, width: int | Column) -> Column:
    width = _column(width)
    return F.coalesce(
        (F.size(matrix) == _column(rows)) & F.forall(matrix, lambda row: F.size(row) == width),
        F.lit(False),
    )


def first_row_failing(matrix: Column, good) -> Column:
    """0-based position of the first row for which `good(row)` is not true; NULL when none."""
    position = F.array_position(
        F.transform(matrix, lambda row: F.coalesce(good(row), F.lit(False))), F.lit(False)
    )
    return F.when(position > 0, position - 1).cast("int")


def _column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
