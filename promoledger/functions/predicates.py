"""Row predicates. Each returns a frame or a Column; none runs a job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def live(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.filter(~F.col("is_deleted"))


def equals_if_given(df: DataFrame, column: str, value) -> DataFrame:
    """Optional parameter: ``None`` leaves the frame alone."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def any_of(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Membership in an optional list: ``None`` keeps all rows, an empty list keeps none."""
    if values is None:
        return df
    return df.filter(F.col(column).isin(list(values))) if len(values) else df.filter(F.lit(False))


def ntz(value: str | datetime | date) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def between(column: str, start, end) -> Column:
    """Inclusive at both ends."""
    return F.col(column).between(ntz(start), ntz(end))


def half_open(column: str, start, end) -> Column:
    return (F.col(column) >= ntz(start)) & (F.col(column) < ntz(end))


def month_bounds(year: int, month: int) -> tuple[date, date]:
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def month_slice(df: DataFrame, column: str, year: int, month: int, partition: str | None = None) -> DataFrame:
    """Rows of one calendar month, as a range that reaches the Parquet scan.

    ``month(ts) = m and year(ts) = y`` pushes nothing but IS NOT NULL. With ``partition`` (a
    ``yyyy-MM`` directory column) the same month also prunes directories.
    """
    start, end = month_bounds(year, month)
    rows = df.filter(half_open(column, start, end))
    return rows.filter(F.col(partition) == f"{year:04d}-{month:02d}") if partition else rows


def holds(condition: Column) -> Column:
    """TRUE only where the condition is TRUE (NULL counts as false)."""
    return F.coalesce(condition, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions[1:], conditions[0]) if conditions else F.lit(True)


def any_true(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions[1:], conditions[0]) if conditions else F.lit(False)


def contains_percent(text: Column) -> Column:
    """Does the text hold a literal percent sign?"""
    return text.contains("%")
