"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.functions.scalars import ratio
from promoledger.operators.numbering import top_per_key


def cardinalities(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values of several columns and the row count, as one row."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(f"cardinality_{c}") for c in columns], F.count(F.lit(1)).alias("total_rows"))


def selectivities(df: DataFrame, conditions: Mapping[str, tuple[Column, int]]) -> DataFrame:
    """Share of rows meeting each condition, rounded to its places: ``{name: (condition, places)}``.

    One pass for all of them instead of two counts per condition.
    """
    total = F.count(F.lit(1))
    return df.agg(
        *[ratio(F.count(F.when(cond, F.lit(1))), total, places).alias(name) for name, (cond, places) in conditions.items()]
    )


def _long_form(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null fraction and distinct count per column: value counts first, then a sum per column."""
    counts = _long_form(df, columns).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n")
    nulls = F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0))
    return counts.groupBy("column_name").agg(
        ratio(nulls, total, 6).alias("null_frac"),
        F.count("value").alias("n_distinct"),
        total.alias("n_rows"),
    )


def common_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column with their frequency; ties go to the smaller text.

    Only (column, value, count) rows reach the top-k, and each map task passes on at most ``k``.
    """
    long = _long_form(df, columns).dropna(subset=["value"])
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("__total")).scalar()
    top = top_per_key(counts, ["column_name"], [F.col("n").desc(), F.col("value").asc()], k)
    return top.select("column_name", "value", "n", ratio(F.col("n"), total, 6).alias("frequency"))


# Relative standard error of a distinct count is about 1.04 / sqrt(2 ** HLL_BITS): 0.8 %. The rank of a quantile is off by
# about 0.7 % with KLL_SIZE. A value's count is off by at most 3.5 * n / TRACKED; no value more frequent than that is missed.
HLL_BITS, KLL_SIZE, TRACKED = 14, 400, 10_000


def profile_sketches(df: DataFrame, partition: str, columns: Sequence[str]) -> DataFrame:
    """One row per value of ``partition`` and column: row and NULL counts and sketches that can be merged.

    One pass: every column is an aggregate of the same grouping, so no row is copied per column, and the sketches,
    whose size is bounded, are built in the map tasks before the shuffle. Columns are told apart only after
    that. ``quantiles`` is NULL for columns that are not numbers; NaN counts as a value in none of them.
    """
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    rows = F.count(F.lit(1)).alias("n_rows")
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        real = F.nanvl(F.col(c).cast("double"), F.lit(None)) if c in numbers else F.lit(None).cast("double")
        sketched = F.struct(
            F.lit(c).alias("column_name"),
            rows,
            F.count_if(F.col(c).isNull()).alias("n_nulls"),
            F.hll_sketch_agg(value, HLL_BITS).alias("distinct"),
            F.when(F.count(real) > 0, F.kll_sketch_agg_double(real, KLL_SIZE)).alias("quantiles"),
            F.expr(f"approx_top_k_accumulate(CAST(`{c}` AS STRING), {TRACKED})").alias("frequent"),
        )
        parts.append(sketched)
    return df.groupBy(partition).agg(F.array(*parts).alias("__all")).select(partition, F.inline("__all"))


def merged_profile(sketches: DataFrame, quantile: float = 0.5, k: int = 10) -> DataFrame:
    """(column_name, n_rows, n_nulls, n_distinct, quantile, common): one row per column from stored sketches.

    Reads no data row. ``common`` lists up to ``k`` values with their estimated counts, most frequent first.
    """
    merged = sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_nulls").alias("n_nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.when(F.count("quantiles") > 0, F.kll_merge_agg_double("quantiles")).alias("__q"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {k + 1})").alias("__top"),
    )
    # NULL is counted as a value there.
    merged = merged.withColumn("common", F.slice(F.filter("__top", lambda x: x["item"].isNotNull()), 1, k)).drop("__top")
    return merged.withColumn("quantile", F.when(F.col("__q").isNotNull(), F.kll_sketch_get_quantile_double("__q", F.lit(quantile)))).drop("__q")


def refresh_profiles(df: DataFrame, partition: str, columns: Sequence[str], path: str) -> None:
    """Store the sketches of the partitions in ``df``; those of other partitions stay.

    Pass whole partitions, such as the months that changed: a partition's sketches are replaced, so a rerun counts nothing twice.
    """
    writer = profile_sketches(df, partition, columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)


def analyze(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> None:
    """Collect optimizer statistics of a catalog table."""
    target = f"FOR COLUMNS {', '.join(columns)}" if columns else "FOR ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS {target}")
