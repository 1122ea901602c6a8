"""Feeds in and archives out: files in Parquet, ORC, CSV or JSON, batch or streaming."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.operators.dml import Change, delete_where, insert_ignore
from promoledger.sources.schemas import Table

FORMATS = ("parquet", "orc", "csv", "json")


def read_feed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", streaming: bool = False, **options: str) -> DataFrame:
    """A feed with a declared schema; nothing is inferred.

    ``fmt="kafka"`` (needs the connector on the class path) reads the JSON value of a topic.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        raw = reader.format("kafka").options(**options).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("row")).select("row.*")
    if fmt not in FORMATS:
        raise ValueError(f"unknown feed format {fmt}")
    if fmt == "csv":
        options = {"header": "true", **options}
    return reader.format(fmt).schema(schema).options(**options).load(path)


def load_table(spark: SparkSession, path: str, table: Table, fmt: str = "parquet") -> DataFrame:
    return read_feed(spark, path, table.schema, fmt)


def copy_into(df: DataFrame, path: str, columns: list[str] | None = None, fmt: str = "parquet") -> None:
    """Append (a projection of) a frame to another dataset."""
    (df.select(*columns) if columns else df).write.format(fmt).mode("append").save(path)


def load_daily(target: DataFrame, feed: DataFrame, key: str = "click_id") -> Change:
    """Idempotent daily load: a feed restarted from the top inserts only what is missing.

    Store ``changed`` as the day's own folder (overwritten by a rerun); the log itself is not rewritten.
    """
    return insert_ignore(target, feed, [key])


def archive(
    history: DataFrame, path: str, as_of, days: int = 90, column: str = "changed_at", key: str = "history_id", fmt: str = "parquet"
) -> DataFrame:
    """Move rows older than ``days`` to month folders of the lake; returns the rows that stay.

    A run that starts over adds only rows the lake lacks; the comparison reads (month, key) alone.
    """
    cutoff = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_interval(days=F.lit(days))
    split = delete_where(history, F.col(column) < cutoff)
    old = split.changed.withColumn("month", F.date_format(F.col(column).cast("date"), "yyyy-MM"))
    schema = T.StructType([*history.schema.fields, T.StructField("month", T.StringType())])
    try:
        stored = history.sparkSession.read.schema(schema).format(fmt).load(path).select("month", key)
        old = old.join(stored, ["month", key], "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    old.hint("rebalance", "month").write.mode("append").partitionBy("month").format(fmt).save(path)
    return split.table
