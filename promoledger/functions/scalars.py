"""Column helpers whose results differ from Spark's plain functions in some corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def zero_if_null(value: Column) -> Column:
    """Sum of money over no rows is 0.00, not NULL."""
    return F.coalesce(value.cast(MONEY), F.lit(0).cast(MONEY))


def percentage(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` to two places, half up, NULL when ``whole`` is 0 or NULL."""
    exact = part.cast("decimal(20,2)") * F.lit(100).cast("decimal(3,0)") / F.nullif(
        whole.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)")
    )
    return F.round(exact, 2).cast("decimal(38,2)")


def ratio(part: Column, whole: Column, places: int) -> Column:
    """``part / whole`` rounded to ``places``, NULL when ``whole`` is 0."""
    exact = part.cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(exact, places).cast(f"decimal(38,{places})")


def day_of(ts: Column) -> Column:
    """Start of the day as a zone-less timestamp, whatever the session zone is."""
    return ts.cast("date").cast("timestamp_ntz")


def month_of(ts: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(ts.cast("date"), "month")


def split_list(text: Column, separator: str = ",") -> Column:
    """Split and trim; an empty text is an empty list and NULL stays NULL."""
    parts = F.transform(F.split(text, separator), lambda v: F.trim(v))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(parts)


def list_length(values: Column) -> Column:
    """Number of elements, NULL for an empty list."""
    return F.nullif(F.size(values), F.lit(0))


def first_element(values: Column) -> Column:
    return F.get(values, 0)


def ascending(value: Column) -> Column:
    """Ascending, NULLs last."""
    return value.asc_nulls_last()


def descending(value: Column, nulls_last: bool = False) -> Column:
    """Descending, NULLs first unless asked otherwise."""
    return value.desc_nulls_last() if nulls_last else value.desc_nulls_first()


def or_default(value: Column, fallback: Column) -> Column:
    return F.coalesce(value, fallback)


def distinct_from(left: Column, right: Column) -> Column:
    """NULL-safe inequality: never NULL itself."""
    return ~left.eqNullSafe(right)
