"""Streaming jobs run to the end over the event log, checked against their batch twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.functions.scalars import MONEY
from promoledger.session import scratch_path
from promoledger.sources.feeds import read_feed
from promoledger.streaming import batches, jobs
from promoledger.workload.views import sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


def _stream(spark, sf, name="events") -> DataFrame:
    # As a glob the path may be one file or a folder of files; a plain path must be a folder.
    return read_feed(spark, f"{sf}/{name}.[p]arquet", table(spark, sf, name).schema, streaming=True)


def _paths(spark, label):
    root = scratch_path(spark, label)
    return f"{root}/out", f"{root}/checkpoint"


@query("SELECT event_id, ts, user_id, event_type FROM events")
def streamed_ingest(spark, sf):
    return _ingested(spark, sf)


@query("SELECT event_id, ts, user_id, event_type FROM events")
def streamed_ingest_with_state(spark, sf):
    return _ingested(spark, sf, watermark="1 hour")


def _ingested(spark, sf, **options):
    path, checkpoint = _paths(spark, "ingest")
    clicks = _stream(spark, sf).select("event_id", "ts", "user_id", "event_type")
    # The source delivers every click twice.
    twice = clicks.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    jobs.ingest_clicks(twice, path, checkpoint, "event_id", "ts", **options).awaitTermination()
    return batches.read_batches(spark, path, clicks.schema).drop(batches.BATCH)


_HOURS_SQL = (
    "SELECT ip_address, window_start, window_start + INTERVAL 1 HOUR AS window_end, n_clicks, TRUE AS is_final FROM (SELECT props AS ip_address, "
    "date_trunc('hour', ts)::TIMESTAMP AS window_start, count(*) AS n_clicks FROM events GROUP BY ALL) WHERE n_clicks >= 2"
)


@query(_HOURS_SQL)
def streamed_fraud_windows(spark, sf):
    return _bursts(spark, _stream(spark, sf))


@query(_HOURS_SQL)
def streamed_fraud_windows_in_parts(spark, sf):
    """The same from files that arrive one after the other in time order, a micro-batch each: windows
    over a border are counted in two batches."""
    events = table(spark, sf, "events")
    root = scratch_path(spark, "parts")
    first, *cuts = events.selectExpr("percentile_approx(unix_micros(cast(ts as timestamp)), array(0.0, 0.33, 0.67))").first()[0]
    at = F.expr("unix_micros(cast(ts as timestamp))")
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = events if low is None else events.filter(at > low)
        (part if high is None else part.filter(at <= high)).coalesce(1).write.mode("append").parquet(root)
    return _bursts(spark, read_feed(spark, root, events.schema, streaming=True, maxFilesPerTrigger="1"))


def _bursts(spark, events, *window) -> DataFrame:
    path, checkpoint = _paths(spark, "bursts")
    clicks = events.select(F.col("ts").alias("clicked_at"), F.col("props").alias("ip_address"))
    windows = jobs.burst_windows(clicks, 2, *(window or ("1 hour",)))
    jobs.burst_updates(windows, path, checkpoint).awaitTermination()
    return jobs.stored_bursts(spark, path, windows.schema)


@query(
    "SELECT ip_address, window_start, window_start + INTERVAL 1 HOUR AS window_end, n_clicks, TRUE AS is_final FROM (SELECT props AS ip_address, "
    "time_bucket(INTERVAL 30 MINUTE, ts) - d * INTERVAL 30 MINUTE AS window_start, count(*) AS n_clicks FROM events, (VALUES (0), (1)) s(d) GROUP BY ALL) "
    "WHERE n_clicks >= 2"
)
def streamed_sliding_windows(spark, sf):
    return _bursts(spark, _stream(spark, sf), "1 hour", "30 minutes")


@query(
    sql(
        "SELECT a.claim_id, a.voucher_id, a.claimed_at, coalesce(a.n <= v.issuance_limit - v.total_issued, FALSE) AS granted FROM (SELECT *, row_number() "
        "OVER (PARTITION BY voucher_id ORDER BY claimed_at, claim_id) AS n FROM arrivals) a LEFT JOIN vouchers v ON v.voucher_id = a.voucher_id",
        "arrivals", "vouchers",
    )
)
def streamed_quota_admission(spark, sf):
    path, checkpoint = _paths(spark, "admission")
    claims = _stream(spark, sf).select(
        F.col("event_id").alias("claim_id"), F.col("user_id").alias("voucher_id"), F.col("ts").alias("claimed_at")
    )
    jobs.admit_claims(claims, view(spark, sf, "vouchers"), path, checkpoint, "voucher_id", ["claimed_at", "claim_id"]).awaitTermination()
    schema = claims.schema.add("granted", "boolean")
    return batches.read_batches(spark, f"{path}/claims", schema).drop(batches.BATCH)


@query(
    "SELECT user_id, old_event_type, ts AS changed_at, props AS changed_by, 'UPDATE' AS change_type FROM (SELECT *, lag(event_type) OVER "
    "(PARTITION BY user_id ORDER BY ts, event_id) AS old_event_type FROM events) WHERE old_event_type IS NOT NULL AND event_type <> old_event_type"
)
def streamed_change_capture(spark, sf):
    path, checkpoint = _paths(spark, "capture")
    images = _stream(spark, sf).select("user_id", "event_type", "ts", "event_id", "props")
    jobs.capture_stream(images, path, checkpoint, "user_id", ["event_type"], ["ts", "event_id"], "ts", "props").awaitTermination()
    schema = table(spark, sf, "events").select(
        "user_id", F.col("event_type").alias("old_event_type"), F.col("ts").alias("changed_at"), F.col("props").alias("changed_by"),
        F.lit("UPDATE").alias("change_type"),
    ).schema
    return batches.read_batches(spark, f"{path}/history", schema).drop(batches.BATCH)


@query(
    sql(
        "SELECT a.voucher_id, v.total_issued + count(*) AS used, v.issuance_limit FROM arrivals a JOIN vouchers v ON v.voucher_id = a.voucher_id "
        "GROUP BY a.voucher_id, v.total_issued, v.issuance_limit HAVING v.total_issued + count(*) >= 0.9 * v.issuance_limit",
        "arrivals", "vouchers",
    )
)
def streamed_quota_alerts(spark, sf):
    path, checkpoint = _paths(spark, "alerts")
    claims = _stream(spark, sf).select(F.col("user_id").alias("voucher_id"))
    alerts = jobs.quota_alert_stream(claims, view(spark, sf, "vouchers"), "voucher_id")
    batches.sink_batches(alerts, path, checkpoint, "update").awaitTermination()
    return batches.latest_updates(spark, path, alerts.schema, ["voucher_id"])


@query(
    sql(
        "SELECT program_id, CAST(coalesce(sum(amount) FILTER (WHERE entry_type = 'income'), 0) AS DECIMAL(18,2)) AS total_income, "
        "CAST(coalesce(sum(amount) FILTER (WHERE entry_type = 'spend'), 0) AS DECIMAL(18,2)) AS actual_spent FROM ledger GROUP BY program_id",
        "ledger",
    )
)
def streamed_running_balance(spark, sf):
    path, checkpoint = _paths(spark, "balance")
    kind = F.when(F.col("o_orderstatus") == "F", "income").when(F.col("o_orderstatus") == "O", "spend").otherwise("adjustment")
    ledger = _stream(spark, sf, "orders").select(
        F.col("o_custkey").alias("program_id"), kind.alias("entry_type"), F.col("o_totalprice").cast(MONEY).alias("amount")
    )
    balance = jobs.running_balance(ledger)
    batches.sink_batches(balance, path, checkpoint, "update").awaitTermination()
    return batches.latest_updates(spark, path, balance.schema, ["program_id"])
