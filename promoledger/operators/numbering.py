"""Row numbers, ranks and neighbours that stay balanced when one key holds most of the rows.

A plain ``row_number() over (partition by key ...)`` sends all rows of a key to one task. Here only
keys below ``hot_rows`` go that way. Rows of hotter keys are range-partitioned by (key, order), so
a key spreads over many tasks; each row's position inside its partition plus the number of rows of
the key in earlier partitions is its rank. The partitioned rows are written once, because sampled
range bounds may differ between two evaluations of the same plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promoledger.functions.joins import null_safe_join
from promoledger.session import materialize

HOT_ROWS = 5_000_000

_SEQ, _PART, _SHIFT = "__seq", "__part", 1 << 33


@dataclass(frozen=True)
class HotRows:
    """Rows of the hot keys and the number of range partitions that keeps each near ``hot_rows``."""

    rows: DataFrame
    partitions: int


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, HotRows | None]:
    """(rows of ordinary keys, rows of keys with more than ``hot_rows`` rows or ``None``).

    The list of hot keys has at most ``rows / hot_rows`` entries, so it is safe to broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    found = materialize(counts.filter(F.col("__n") > hot_rows), "hot-keys")
    total = found.agg(F.sum("__n")).first()[0]
    if total is None:
        return df, None
    hot_keys = F.broadcast(found.drop("__n"))
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = HotRows(null_safe_join(df, hot_keys, keys, "left_semi"), max(configured, -(-total // hot_rows)))
    return null_safe_join(df, hot_keys, keys, "left_anti"), hot


def _positions(df: DataFrame, order_by: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Range-partitioned, sorted, written rows with partition number and position in it."""
    ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    ordered = ranged.sortWithinPartitions(*order_by)
    written = materialize(ordered.withColumn(_SEQ, F.monotonically_increasing_id()), "ranges")
    return written.withColumn(_PART, F.floor(F.col(_SEQ) / _SHIFT)).withColumn(_SEQ, F.col(_SEQ) % _SHIFT)


def number_rows(
    df: DataFrame, order_by: Sequence[Column], column: str = "row_num", start: Column | int = 0, partitions: int | None = None
) -> DataFrame:
    """Number all rows 1, 2, 3, ... (after ``start``) in a total order, without one global task.

    The rows are spread over ``partitions`` tasks, by default ``spark.sql.shuffle.partitions``.
    """
    rows = _positions(df, order_by, partitions)
    # One row per range partition: a window in one task and a broadcast are both bounded by that.
    parts = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(_PART, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    first = F.lit(start) if isinstance(start, int) else start
    number = (first + F.col("__before") + F.col(_SEQ) + 1).cast("bigint")
    return rows.join(F.broadcast(offsets), _PART).withColumn(column, number).drop(_PART, _SEQ, "__before")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    column: str = "row_num",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number()`` per key over a total order; see the module text for hot keys."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    cold, hot = split_hot(df, keys, hot_rows)
    ranked = cold.withColumn(column, F.row_number().over(window).cast("bigint"))
    if hot is None:
        return ranked
    return ranked.unionByName(_rank_hot(hot, keys, order_by, column).select(ranked.columns))


def _rank_hot(hot: HotRows, keys: Sequence[str], order_by: Sequence[Column], column: str) -> DataFrame:
    rows = _positions(hot.rows, [F.col(k).asc_nulls_first() for k in keys] + list(order_by), hot.partitions)
    # One row per (partition, key): at most hot keys + partitions rows, since keys are contiguous.
    runs = rows.groupBy(_PART, *keys).agg(F.min(_SEQ).alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    rank = (F.col("__before") + F.col(_SEQ) - F.col("__first") + 1).cast("bigint")
    joined = null_safe_join(rows, F.broadcast(offsets), [_PART, *keys], "inner")
    return joined.select(*hot.rows.columns, rank.alias(column))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    previous: Mapping[str, str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add columns of the preceding row of the same key: ``{new column: source column}``.

    Rows of hot keys are ranked and joined to themselves on (key, rank - 1), which spreads evenly.
    """
    cold, hot = split_hot(df, keys, hot_rows)
    window = Window.partitionBy(*keys).orderBy(*order_by)
    result = cold.withColumns(
        {"__first": F.row_number().over(window) == 1, **{n: F.lag(s).over(window) for n, s in previous.items()}}
    ).withColumnRenamed("__first", "is_first")
    if hot is None:
        return result
    ranked = materialize(_rank_hot(hot, keys, order_by, "__rank"), "ranked")
    earlier = ranked.select(
        *keys, (F.col("__rank") + 1).alias("__rank"), *[F.col(s).alias(n) for n, s in previous.items()]
    )
    linked = null_safe_join(ranked, earlier, ["__rank", *keys], "left").select(
        *df.columns, (F.col("__rank") == 1).alias("is_first"), *previous
    )
    return result.unionByName(linked)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and map task before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") == 1).drop("__rn")


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """At most ``k`` rows of each key.

    Up to Spark's group-limit threshold the groups are cut before the shuffle; a larger ``k`` ranks
    the rows in the form that spreads hot keys.
    """
    if k > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return rank_within(df, keys, order_by, "__rn").filter(F.col("__rn") <= k).drop("__rn")
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(window)).filter(F.col("__rn") <= k).drop("__rn")
