"""Seeded random clicks for layout experiments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_STEPS = 1 << 40


def _uniform(seed: int) -> Column:
    """Pseudo-random value in [0, 1) from the row id, the same for any partitioning."""
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(_STEPS)) / F.lit(float(_STEPS))


def random_clicks(
    spark: SparkSession, n: int, start: str = "2026-01-01", days: int = 181, partners: int = 5, seed: int = 7, first_id: int = 1
) -> DataFrame:
    """``n`` clicks: uniform partners and times, about 10 % suspicious and 30 % reconciled."""
    seconds = (_uniform(seed + 1) * (days * 86_400)).cast("decimal(18,6)")
    return spark.range(first_id, first_id + n).select(
        F.col("id").alias("click_id"),
        (1 + F.floor(_uniform(seed) * partners)).cast("bigint").alias("partner_id"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).alias("clicked_at"),
        (_uniform(seed + 2) < 0.1).alias("is_suspicious"),
        F.when(_uniform(seed + 3) < 0.3, F.lit(1).cast("bigint")).alias("reconciliation_status_id"),
    )
