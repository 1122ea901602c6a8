"""Micro-batch plumbing: replay-safe sinks and keyed state kept as a table.

``foreachBatch`` may hand over a batch twice. Every sink here writes ``path/batch_id=N`` by overwrite
and reads only earlier batches, so a replay gives the same result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from promoledger.session import scratch_scope
from promoledger.sources.literal import literal

BATCH = "batch_id"


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Zone-less time to ``timestamp``, which watermarks ask for; ``zoneless`` turns it back."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def read_batches(spark: SparkSession, path: str, schema: T.StructType, first: int = 0, before: int | None = None) -> DataFrame:
    """Rows of the written batches ``first <= batch_id < before``, with their ``batch_id``."""
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        rows = spark.read.schema(full).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return literal(spark, [], full)
    rows = rows.filter(F.col(BATCH) >= first)
    return rows if before is None else rows.filter(F.col(BATCH) < before)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


class KeyedState:
    """Latest row per key, stored as one delta per batch and a full copy every ``full_every`` batches.

    Reading looks at no more than ``full_every`` deltas, whatever the age of the stream.
    """

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], schema: T.StructType, full_every: int = 20):
        self.spark, self.path, self.key, self.schema, self.full_every = spark, path, list(key), schema, full_every

    def before(self, batch_id: int) -> DataFrame:
        first = max(batch_id - 1, 0) // self.full_every * self.full_every
        return self._latest(read_batches(self.spark, self.path, self.schema, first, batch_id))

    def save(self, batch_id: int, delta: DataFrame) -> None:
        if batch_id and batch_id % self.full_every == 0:
            older = self.before(batch_id).withColumn(BATCH, F.lit(batch_id - 1).cast("bigint"))
            newer = delta.select(*older.columns[:-1]).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            delta = self._latest(older.unionByName(newer))
        write_batch(delta.select(*self.schema.fieldNames()), self.path, batch_id)

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in self.schema.fieldNames() if c not in self.key]
        newest = rows.groupBy(*self.key).agg(F.max_by(F.struct(*values), BATCH).alias("__v"))
        return newest.select(*self.key, *[F.col(f"__v.{c}").alias(c) for c in values]).select(*self.schema.fieldNames())


def start_batches(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], mode: str = "append", available_now: bool = True
) -> StreamingQuery:
    """Run ``handle(batch, batch_id)`` per micro-batch.

    The batch is kept while the handler reads it several times: without that each read would run the
    stateful part of the stream again. Intermediates of the handler go when it returns.
    """

    def kept(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            with scratch_scope(batch.sparkSession):
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(kept).outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def sink_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", available_now: bool = True) -> StreamingQuery:
    """Write every micro-batch to its own folder."""
    writer = stream.writeStream.foreachBatch(lambda df, n: write_batch(df, path, n)).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest_updates(spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """Last emitted row per key of an update-mode sink."""
    return KeyedState(spark, path, key, schema)._latest(read_batches(spark, path, schema))
