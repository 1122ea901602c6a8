"""Joins whose keys treat NULL as a value."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys, NULL matching NULL; the result has the keys of the left side."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])
