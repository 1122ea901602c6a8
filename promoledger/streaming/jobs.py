"""Streaming jobs. On a bounded input each ends with the result of its batch twin."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from promoledger.functions.predicates import between
from promoledger.functions.scalars import MONEY, zero_if_null
from promoledger.operators.audit import capture_from_images
from promoledger.operators.counters import grant_claims
from promoledger.operators.dml import insert_ignore
from promoledger.operators.numbering import HOT_ROWS
from promoledger.streaming.batches import (
    KeyedState, event_time, latest_updates, read_batches, sink_batches, start_batches, write_batch, zoneless,
)


def ingest_clicks(
    stream: DataFrame, path: str, checkpoint: str, key: str = "click_id", time: str = "clicked_at",
    watermark: str | None = None, replays_keep_time: bool = False, available_now: bool = True,
) -> StreamingQuery:
    """Idempotent ingest: copies inside a batch are dropped before the shuffle, replays of any age by an
    anti-join against what is already stored.

    That join reads the key column of the stored log. Where a replay is known to carry the original
    event time, ``replays_keep_time`` limits the read to the time span of the batch. ``watermark`` adds
    stream state that drops copies delivered within that time earlier; it moves every copy of a click
    to one task, so leave it out where single clicks are repeated en masse.
    """
    schema = stream.schema
    once = event_time(stream, time)
    if watermark:
        once = once.withWatermark(time, watermark).dropDuplicatesWithinWatermark([key])

    def store(batch: DataFrame, batch_id: int) -> None:
        stored = read_batches(batch.sparkSession, path, schema, before=batch_id).select(*schema.fieldNames())
        rows = zoneless(batch, time).select(*schema.fieldNames())
        if replays_keep_time:
            low, high = rows.agg(F.min(time), F.max(time)).first()
            stored = stored.filter(between(time, low, high) if low else F.lit(False))
        write_batch(insert_ignore(stored, rows, [key]).changed, path, batch_id)

    return start_batches(once, checkpoint, store, "append", available_now)


def burst_windows(
    stream: DataFrame, threshold: int, window: str = "1 minute", slide: str | None = None,
    watermark: str = "10 minutes", time: str = "clicked_at", key: str = "ip_address",
) -> DataFrame:
    """Windows in which one address reaches the threshold, emitted once the watermark has passed
    them; clicks later than that are dropped. Tumbling unless ``slide`` is given."""
    timed = event_time(stream, time).withWatermark(time, watermark)
    bucket = F.window(time, window, slide) if slide else F.window(time, window)
    counts = timed.groupBy(bucket.alias("w"), key).agg(F.count(F.lit(1)).alias("n_clicks"))
    return counts.filter(F.col("n_clicks") >= threshold).select(
        key, F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n_clicks",
    )


def burst_updates(windows: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Store the windows of ``burst_windows`` as they grow: every micro-batch writes those it changed.

    The watermark bounds the state as before, but no window waits for it to be seen."""
    return sink_batches(windows, path, checkpoint, "update", available_now)


def stored_bursts(
    spark: SparkSession, path: str, schema: T.StructType, closed_to: object | None = None, key: str = "ip_address"
) -> DataFrame:
    """The windows stored by ``burst_updates``, each with its last count, and ``is_final``.

    ``closed_to`` is the time up to which all clicks have been delivered: windows that end later are
    provisional. Without it the input has ended, and every window is final, the open ones included.
    """
    last = latest_updates(spark, path, schema, [key, "window_start", "window_end"])
    final = F.lit(True) if closed_to is None else F.col("window_end") <= F.lit(str(closed_to)).cast("timestamp_ntz")
    return last.withColumn("is_final", final)


def admit_claims(
    stream: DataFrame, quotas: DataFrame, path: str, checkpoint: str, key: str, order_by: Sequence[str],
    limit: str = "issuance_limit", issued: str = "total_issued", available_now: bool = True,
) -> StreamingQuery:
    """Quota admission. Each micro-batch is allocated as a set against the counters left by earlier
    batches, so one hot voucher still spreads over tasks.

    Order holds within a batch by ``order_by`` and between batches by arrival; the result equals the
    batch allocation when files arrive in time order. Claims are taken as they come: let
    ``ingest_clicks`` remove repeated deliveries first.
    """
    state_schema = T.StructType([quotas.schema[key], T.StructField("given", T.LongType())])
    spark = stream.sparkSession
    state = KeyedState(spark, f"{path}/counters", [key], state_schema)

    def admit(batch: DataFrame, batch_id: int) -> None:
        given = state.before(batch_id)
        current = quotas.select(key, limit, issued).join(given, key, "left").select(
            key, limit, (F.col(issued) + F.coalesce("given", F.lit(0))).alias(issued)
        )
        decided = grant_claims(batch, current, key, order_by, limit, issued)
        write_batch(decided, f"{path}/claims", batch_id)
        done = read_batches(spark, f"{path}/claims", decided.schema, batch_id, batch_id + 1)
        fresh = done.filter("granted").groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
        total = (F.coalesce("given", F.lit(0)) + F.col("__n")).alias("given")
        state.save(batch_id, fresh.join(given, key, "left").select(key, total))

    return start_batches(stream, checkpoint, admit, "append", available_now)


def capture_stream(
    stream: DataFrame, path: str, checkpoint: str, key: str, tracked: Sequence[str], order_by: Sequence[str],
    changed_at: str, changed_by: str, hot_rows: int = HOT_ROWS, available_now: bool = True,
) -> StreamingQuery:
    """Change capture from a stream of after-images. The previous image of a key comes from its batch
    or, for the first one in a batch, from the state left by earlier batches."""
    spark = stream.sparkSession
    schema = stream.schema
    state = KeyedState(spark, f"{path}/images", [key], schema)

    def capture(batch: DataFrame, batch_id: int) -> None:
        mentioned = batch.select(key).distinct()
        known = state.before(batch_id).join(mentioned, key, "left_semi").withColumn("__old", F.lit(0))
        images = known.unionByName(batch.withColumn("__old", F.lit(1)))
        order: list[Column] = [F.col("__old"), *[F.col(c) for c in order_by]]
        history = capture_from_images(images, key, tracked, order, changed_at, changed_by, hot_rows)
        write_batch(history, f"{path}/history", batch_id)
        values = [c for c in schema.fieldNames() if c != key]
        last = batch.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(*order_by)).alias("__v"))
        state.save(batch_id, last.select(key, *[F.col(f"__v.{c}").alias(c) for c in values]))

    return start_batches(stream, checkpoint, capture, "append", available_now)


def quota_alert_stream(claims: DataFrame, quotas: DataFrame, key: str, ratio: str = "0.9") -> DataFrame:
    """Running claims per voucher (update mode), passed on from the given share of the quota."""
    running = claims.groupBy(key).agg(F.count(F.lit(1)).alias("claimed"))
    joined = running.join(quotas.select(key, "issuance_limit", "total_issued"), key)
    used = (F.col("total_issued") + F.col("claimed")).alias("used")
    near = F.col("used").cast("decimal(20,4)") >= F.col("issuance_limit") * F.lit(ratio).cast("decimal(6,4)")
    return joined.select(key, used, "issuance_limit").filter(near)


def running_balance(ledger: DataFrame) -> DataFrame:
    """Running income and spend per program (update mode)."""
    sums = [
        zero_if_null(F.sum(F.when(F.col("entry_type") == kind, F.col("amount")))).cast(MONEY).alias(name)
        for kind, name in (("income", "total_income"), ("spend", "actual_spent"))
    ]
    return ledger.groupBy("program_id").agg(*sums)
