"""Physical layout: range, list and hash partitions, pruned reads, clustering, retention.

Declared bounds live in small dataclasses; the partition value is an ordinary column derived from
them, so the same rule serves the write, the pruned read and the row counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.functions.predicates import half_open, month_bounds, ntz
from promoledger.sources.folders import finish_replacement, replace_folder

DEFAULT = "__default__"


@dataclass(frozen=True)
class MonthRange:
    """Monthly range partitions of ``column`` for the months first..last; others go to default."""

    column: str
    first: tuple[int, int]
    last: tuple[int, int]
    partition: str = "month"

    def value(self) -> Column:
        start, _ = month_bounds(*self.first)
        _, end = month_bounds(*self.last)
        name = F.date_format(F.col(self.column).cast("date"), "yyyy-MM")
        return F.when(half_open(self.column, start, end), name).otherwise(F.lit(DEFAULT))

    def months(self) -> list[str]:
        y, m = self.first
        names = []
        while (y, m) <= self.last:
            names.append(f"{y:04d}-{m:02d}")
            y, m = (y + m // 12, m % 12 + 1)
        return names

    def extended(self, last: tuple[int, int]) -> "MonthRange":
        return replace(self, last=max(self.last, last))

    def prune(self, start: date | datetime, end: date | datetime) -> list[str]:
        """Partitions that can hold rows of ``[start, end)``."""
        low, high = _moment(start), _moment(end)
        names = []
        for name in self.months():
            first, after = (_moment(x) for x in month_bounds(int(name[:4]), int(name[5:])))
            if first < high and low < after:
                names.append(name)
        outside = low < _moment(month_bounds(*self.first)[0]) or high > _moment(month_bounds(*self.last)[1])
        return names + [DEFAULT] if outside else names


def _moment(value: date | datetime | str) -> datetime:
    """A point in time from a date, a datetime or ISO text."""
    return datetime.fromisoformat(str(value)).replace(tzinfo=None)


@dataclass(frozen=True)
class ListPartition:
    column: str
    values: tuple
    partition: str = "partition_of"

    def value(self) -> Column:
        return F.when(F.col(self.column).isin(list(self.values)), F.col(self.column).cast("string")).otherwise(
            F.lit(DEFAULT)
        )

    def prune(self, value) -> list[str]:
        return [str(value) if value in self.values else DEFAULT]


@dataclass(frozen=True)
class HashPartition:
    """``modulus`` even parts by a hash of the key; a key lookup reads one part."""

    column: str
    modulus: int
    partition: str = "bucket"

    def value(self) -> Column:
        return F.pmod(F.hash(self.column), F.lit(self.modulus))

    def value_of(self, literal: Column) -> Column:
        return F.pmod(F.hash(literal), F.lit(self.modulus))


Partitioning = MonthRange | ListPartition | HashPartition


def write_partitioned(df: DataFrame, rule: Partitioning, path: str, mode: str = "error", sort: Sequence[str] = ()) -> None:
    """Write with one directory per partition value.

    ``rebalance`` lets adaptive execution split a partition value that holds most rows over several
    tasks and merge small ones, so no task writes a whole hot month or partner. The dynamic
    overwrite of ``mode="overwrite"`` replaces only the partitions present in ``df``.
    """
    rows = df.withColumn(rule.partition, rule.value()).hint("rebalance", rule.partition)
    if sort:
        rows = rows.sortWithinPartitions(rule.partition, *sort)
    writer = rows.write.mode(mode).partitionBy(rule.partition)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def partition_counts(df: DataFrame, rule: Partitioning) -> DataFrame:
    """Rows per partition; partitions without rows do not appear."""
    value = F.col(rule.partition) if rule.partition in df.columns else rule.value()
    return df.groupBy(value.alias("partition_name")).agg(F.count(F.lit(1)).alias("row_count"))


def read_range(df: DataFrame, rule: MonthRange, start, end) -> DataFrame:
    """``[start, end)`` of a month-partitioned table: directory pruning plus the exact row filter."""
    return df.filter(F.col(rule.partition).isin(rule.prune(start, end)) & half_open(rule.column, start, end))


def read_listed(df: DataFrame, rule: ListPartition, value) -> DataFrame:
    return df.filter(F.col(rule.partition).isin(rule.prune(value)) & (F.col(rule.column) == value))


def read_key(df: DataFrame, rule: HashPartition, value) -> DataFrame:
    """Point lookup in a hash-partitioned table: one bucket directory is read."""
    literal = F.lit(value).cast(df.schema[rule.column].dataType)
    return df.filter((F.col(rule.partition) == rule.value_of(literal)) & (F.col(rule.column) == literal))


def out_of_bounds(df: DataFrame, column: str, start, end) -> DataFrame:
    """Rows that stop a dataset from becoming the partition ``[start, end)``; NULL counts as outside."""
    return df.filter(~F.coalesce(half_open(column, start, end), F.lit(False)))


def attach(df: DataFrame, rule: MonthRange, year: int, month: int, path: str) -> MonthRange:
    """Prove the bounds of a finished dataset, then add it as one month partition.

    The default partition must not hold rows of any month that becomes declared by it, gaps included:
    pruned reads would no longer find them; ``add_month`` moves such rows. A month that holds rows
    already is refused.
    """
    start, end = month_bounds(year, month)
    if not out_of_bounds(df, rule.column, start, end).isEmpty():
        raise ValueError(f"rows outside {start}..{end}")
    schema = T.StructType([*df.schema.fields, T.StructField(rule.partition, T.StringType())])
    stored = df.sparkSession.read.schema(schema).parquet(path).filter(F.col(rule.partition) == DEFAULT)
    wider = replace(rule, first=min(rule.first, (year, month)), last=max(rule.last, (year, month)))
    declared = half_open(rule.column, month_bounds(*wider.first)[0], month_bounds(*wider.last)[1])
    if not stored.filter(declared).isEmpty():
        raise ValueError(f"default partition holds rows of the months {wider.first}..{wider.last}")
    present = df.sparkSession.read.schema(schema).parquet(path).filter(F.col(rule.partition) == f"{year:04d}-{month:02d}")
    if not present.isEmpty():
        raise ValueError(f"month {year:04d}-{month:02d} holds rows already")
    write_partitioned(df, wider, path, mode="append")
    return wider


def attach_location(spark: SparkSession, table: str, partition: str, value: str, location: str) -> None:
    """Register an existing directory as a partition of a catalog table: metadata only."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({partition}='{value}') LOCATION '{location}'")


def detach(spark: SparkSession, table: str, partition: str, value: str) -> None:
    """Drop a partition of a catalog table: metadata, no row is read."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition}='{value}')")


def expired_months(rule: MonthRange, as_of: date | datetime, keep: int) -> list[str]:
    """Month partitions that a retention of ``keep`` whole months lets go."""
    year, month = int(str(as_of)[:4]), int(str(as_of)[5:7])
    total = year * 12 + month - 1 - keep
    oldest = f"{total // 12:04d}-{total % 12 + 1:02d}"
    return [m for m in rule.months() if m < oldest]


def drop_months(spark: SparkSession, rule: MonthRange, months: Sequence[str], path: str) -> None:
    """Remove month partitions from stored data: their folders go, no row is read."""
    for month in months:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{rule.partition}={month}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def add_month(df: DataFrame, rule: MonthRange, year: int, month: int) -> tuple[DataFrame, MonthRange]:
    """Declare a further month; default rows that belong to it get their new partition value."""
    wider = rule.extended((year, month))
    return df.withColumn(rule.partition, wider.value()), wider


def add_month_stored(spark: SparkSession, rule: MonthRange, year: int, month: int, path: str, schema: T.StructType) -> MonthRange:
    """Declare months up to the given one on stored data; only the default partition is read and rewritten.

    ``schema`` is that of the rows, without the partition column. Rows of the new months are written to
    their folders first, then the default partition is replaced by the rest, so a crash loses no row: until
    the second step ends the moved rows stand in both places, and running the call again with the old
    ``rule`` finishes it. Other partitions keep their files. Writers to the default partition have to wait.
    """
    wider = rule.extended((year, month))
    default = f"{path}/{rule.partition}={DEFAULT}"
    finish_replacement(spark, default)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(default)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return wider
    rows = spark.read.schema(schema).parquet(default)
    moved = rows.filter(wider.value() != DEFAULT)
    if not moved.isEmpty():
        write_partitioned(moved, wider, path, mode="overwrite")
        replace_folder(rows.filter(wider.value() == DEFAULT), default)
    return wider


def cluster_by(df: DataFrame, *columns: str) -> DataFrame:
    """Order the data physically, so that Parquet min/max statistics can skip row groups."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def write_clustered(df: DataFrame, path: str, *columns: str) -> None:
    cluster_by(df, *columns).write.parquet(path)


def file_overlap(df: DataFrame, column: str) -> DataFrame:
    """Per-file min and max of a column and the number of files whose range it touches.

    Computed on one row per file. A well clustered table has ``overlaps`` near 1 for every file.
    """
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(column).alias("lo"), F.max(column).alias("hi"), F.count(F.lit(1)).alias("n_rows")
    )
    # Ranges touching [lo, hi] = starts at or before hi minus ends before lo, counted along the
    # sorted bounds. Two rows per file, so the one window task is bounded by the number of files.
    starts = per_file.select("file", F.col("lo").alias("at"), F.lit(0).alias("kind"))
    ends = per_file.select("file", F.col("hi").alias("at"), F.lit(1).alias("kind"))
    along = Window.orderBy("at", "kind")
    counted = starts.unionByName(ends).select(
        "file",
        "kind",
        F.count(F.when(F.col("kind") == 0, 1)).over(along).alias("__starts"),
        F.count(F.when(F.col("kind") == 1, 1)).over(along).alias("__ends"),
    )
    until_hi = counted.filter("kind = 1").select("file", F.col("__starts").alias("__a"))
    before_lo = counted.filter("kind = 0").select("file", F.col("__ends").alias("__b"))
    return (
        per_file.join(until_hi, "file").join(before_lo, "file")
        .select("file", "lo", "hi", "n_rows", (F.col("__a") - F.col("__b")).alias("overlaps"))
    )


def clustering_correlation(df: DataFrame, value: Column) -> DataFrame:
    """Correlation of a value with its row's position in the stored table: near 1 when stored in order.

    ``df`` reads Parquet files. A position is the row's index in its file plus the rows of the files
    before it by name; the running sum has one row per file.
    """
    rows = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("__index"), value.cast("double").alias("__value")
    )
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("__n"))
    offsets = files.select("file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    position = (F.col("__before") + F.col("__index")).cast("double")
    # One short row per file; dealt out by file, all rows of a file would meet in one task.
    return rows.join(F.broadcast(offsets), "file").agg(F.corr("__value", position).alias("correlation"))


def unreconciled_extract(clicks: DataFrame) -> DataFrame:
    """The materialised subset "valid and not yet reconciled"."""
    return clicks.filter(~F.col("is_suspicious") & F.col("reconciliation_status_id").isNull())


def bounds_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))


def in_month(column: str, year: int, month: int) -> Column:
    start, end = month_bounds(year, month)
    return (F.col(column) >= ntz(start)) & (F.col(column) < ntz(end))
