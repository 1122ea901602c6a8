import os

import pytest
from pyspark.sql import functions as F

from promoledger.operators.audit import capture_from_images
from promoledger.operators.counters import allocate_capped
from promoledger.plans import reports
from promoledger.session import scratch_root
from promoledger.sources.feeds import read_feed
from promoledger.sources.literal import literal
from promoledger.streaming import batches, jobs
from tests.conftest import rows

CLICK = "click_id string, ip_address string, clicked_at timestamp_ntz"


def intermediates(spark):
    folder = f"{scratch_root(spark)}/promoledger"
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def feed(spark, folder, frames):
    """One file per frame, in order, read one file per micro-batch."""
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(folder)
    return read_feed(spark, folder, frames[0].schema, streaming=True, maxFilesPerTrigger="1")


def clicks(spark, data):
    return literal(spark, data, "click_id string, ip_address string, at string").withColumn("clicked_at", F.col("at").cast("timestamp_ntz")).drop("at")


@pytest.mark.parametrize("options", [{}, {"watermark": "1 hour"}])
def test_ingest_is_idempotent_across_batches_and_restarts(spark, tmp_path, options):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    first = clicks(spark, [("A", "ip", "2026-06-01 00:00:00"), ("B", "ip", "2026-06-01 00:01:00"), ("A", "ip", "2026-06-01 00:00:00")])
    again = clicks(spark, [("B", "ip", "2026-06-01 00:01:00"), ("C", "ip", "2026-06-01 00:02:00")])
    jobs.ingest_clicks(feed(spark, folder, [first, again]), out, checkpoint, **options).awaitTermination()
    stored = batches.read_batches(spark, out, first.schema)
    assert rows(stored, "click_id") == [("A",), ("B",), ("C",)]
    # The partner sends the day again, long after the watermark: a new stream, an empty state.
    late = clicks(spark, [("D", "ip", "2026-06-09 00:00:00"), ("A", "ip", "2026-06-09 00:00:00")])
    stream = feed(spark, folder, [late])
    jobs.ingest_clicks(stream, out, checkpoint, **options).awaitTermination()
    assert rows(batches.read_batches(spark, out, first.schema), "click_id") == [("A",), ("B",), ("C",), ("D",)]


def test_ingest_of_replays_that_keep_their_time(spark, tmp_path):
    first = clicks(spark, [("A", "ip", "2026-06-01 00:00:00"), ("B", "ip", "2026-06-01 00:01:00")])
    again = clicks(spark, [("B", "ip", "2026-06-01 00:01:00"), ("C", "ip", "2026-06-01 00:02:00")])
    stream = feed(spark, str(tmp_path / "in"), [first, again])
    jobs.ingest_clicks(stream, str(tmp_path / "out"), str(tmp_path / "cp"), replays_keep_time=True).awaitTermination()
    assert rows(batches.read_batches(spark, str(tmp_path / "out"), first.schema), "click_id") == [("A",), ("B",), ("C",)]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    path = str(tmp_path / "sink")
    frame = spark.range(3).select("id")
    for _ in range(2):
        batches.write_batch(frame, path, 0)
    batches.write_batch(frame, path, 1)
    assert batches.read_batches(spark, path, frame.schema).count() == 6
    assert batches.read_batches(spark, path, frame.schema, before=1).count() == 3
    assert batches.read_batches(spark, str(tmp_path / "none"), frame.schema).isEmpty()


def test_keyed_state_reads_few_deltas(spark, tmp_path):
    schema = literal(spark, [], "k int, v int").schema
    state = batches.KeyedState(spark, str(tmp_path / "state"), ["k"], schema, full_every=3)
    latest = {}
    for n in range(8):
        assert {r.k: r.v for r in state.before(n).collect()} == latest
        state.save(n, literal(spark, [(n % 4, n)], "k int, v int"))
        latest[n % 4] = n
    assert {r.k: r.v for r in state.before(8).collect()} == latest
    # A replay of the last batch changes nothing.
    state.save(7, literal(spark, [(3, 7)], "k int, v int"))
    assert {r.k: r.v for r in state.before(8).collect()} == latest


def test_bursts_drop_late_clicks_and_equal_the_batch_twin(spark, tmp_path):
    minute = [(f"x{i}", "hot", f"2026-06-01 10:00:{i:02d}") for i in range(5)] + [("y", "cold", "2026-06-01 10:00:30")]
    later = [("z", "cold", "2026-06-01 10:30:00"), ("w", "cold", "2026-06-01 11:30:00")]
    too_late = [(f"l{i}", "hot", "2026-06-01 10:00:59") for i in range(9)]
    # Late rows are judged by the watermark of the batch before, hence the batch in between.
    between = [("v", "cold", "2026-06-01 11:31:00")]
    frames = [clicks(spark, d) for d in (minute, later, between, too_late, [("e", "cold", "2026-06-01 13:00:00")])]
    windows = jobs.burst_windows(feed(spark, str(tmp_path / "in"), frames), 5)
    batches.sink_batches(windows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = batches.read_batches(spark, str(tmp_path / "out"), windows.schema)
    twin = reports.bursts(frames[0].unionByName(frames[1]), 5)
    assert rows(got, "ip_address", "window_start", "n_clicks") == rows(twin, "ip_address", "window_start", "n_clicks")
    flagged = reports.flag_bursts(frames[0].withColumn("is_suspicious", F.lit(False)), 5)
    assert flagged.filter("is_suspicious").count() == 5


def test_sliding_windows(spark, tmp_path):
    data = [("a", "ip", "2026-06-01 10:00:40"), ("b", "ip", "2026-06-01 10:01:10"), ("c", "other", "2026-06-01 12:00:00")]
    windows = jobs.burst_windows(feed(spark, str(tmp_path / "in"), [clicks(spark, data)]), 2, "1 minute", "30 seconds")
    batches.sink_batches(windows, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    got = batches.read_batches(spark, str(tmp_path / "out"), windows.schema).collect()
    assert [(r.ip_address, str(r.window_start), r.n_clicks) for r in got] == [("ip", "2026-06-01 10:00:30", 2)]


def test_admission_over_batches_equals_batch_allocation(spark, tmp_path):
    claims = spark.range(120).select(F.col("id").alias("claim_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).cast("bigint").alias("voucher_id"))
    quotas = literal(spark, [(v, 20, v) for v in range(5)], "voucher_id bigint, issuance_limit int, total_issued int")
    parts = [claims.filter((F.col("claim_id") >= a) & (F.col("claim_id") < a + 30)) for a in (0, 30, 60, 90)]
    stream = feed(spark, str(tmp_path / "in"), parts)
    before = intermediates(spark)
    jobs.admit_claims(stream, quotas, str(tmp_path / "out"), str(tmp_path / "cp"), "voucher_id", ["claim_id"]).awaitTermination()
    assert intermediates(spark) == before
    got = batches.read_batches(spark, str(tmp_path / "out" / "claims"), claims.schema.add("granted", "boolean"))
    twin = allocate_capped(claims, quotas, "voucher_id", [F.col("claim_id")])
    assert rows(got, "claim_id", "granted") == rows(twin, "claim_id", "granted")


@pytest.mark.parametrize("hot_rows", [5, 100_000])
def test_capture_over_batches_equals_batch_capture(spark, tmp_path, hot_rows):
    images = spark.range(90).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("program_id"), F.col("id").alias("seq"),
        F.when(F.col("id") % 4 == 0, None).otherwise((F.col("id") / 10).cast("int")).alias("budget_limit"),
        F.lit("2026-06-01").cast("timestamp_ntz").alias("at"), F.concat(F.lit("u"), "id").alias("who"),
    )
    parts = [images.filter((F.col("seq") >= a) & (F.col("seq") < a + 30)) for a in (0, 30, 60)]
    stream = feed(spark, str(tmp_path / "in"), parts)
    jobs.capture_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "program_id", ["budget_limit"], ["seq"], "at", "who", hot_rows).awaitTermination()
    twin = capture_from_images(images, "program_id", ["budget_limit"], [F.col("seq")], "at", "who")
    got = batches.read_batches(spark, str(tmp_path / "out" / "history"), twin.schema)
    assert rows(got, *twin.columns) == rows(twin)


def test_alerts_and_balance_in_update_mode(spark, tmp_path):
    quotas = literal(spark, [(1, 10, 5), (2, 100, 0)], "voucher_id bigint, issuance_limit int, total_issued int")
    parts = [literal(spark, [(1,)] * 3 + [(2,)], "voucher_id bigint"), literal(spark, [(1,)] * 2, "voucher_id bigint")]
    alerts = jobs.quota_alert_stream(feed(spark, str(tmp_path / "a"), parts), quotas, "voucher_id", "0.8")
    batches.sink_batches(alerts, str(tmp_path / "ao"), str(tmp_path / "ac"), "update").awaitTermination()
    assert rows(batches.latest_updates(spark, str(tmp_path / "ao"), alerts.schema, ["voucher_id"])) == [(1, 10, 10)]

    entry = "program_id bigint, entry_type string, amount string"
    entries = [[(1, "spend", "10"), (1, "income", "5")], [(1, "spend", "2.50"), (2, "adjustment", "9")]]
    ledger = feed(spark, str(tmp_path / "l"), [literal(spark, e, entry).withColumn("amount", F.col("amount").cast("decimal(18,2)")) for e in entries])
    balance = jobs.running_balance(ledger)
    batches.sink_batches(balance, str(tmp_path / "lo"), str(tmp_path / "lc"), "update").awaitTermination()
    got = batches.latest_updates(spark, str(tmp_path / "lo"), balance.schema, ["program_id"])
    assert [tuple(str(v) for v in r) for r in rows(got)] == [("1", "5.00", "12.50"), ("2", "0.00", "0.00")]


def test_bursts_open_at_the_end_are_stored_and_marked(spark, tmp_path):
    schema, source = "clicked_at timestamp_ntz, ip_address string", str(tmp_path / "in")
    log = [("2026-06-01 10:00:50", "a"), ("2026-06-01 10:00:10", "a")], [("2026-06-01 10:00:55", "a"), ("2026-06-01 10:20:01", "b")], [("2026-06-01 10:20:59", "b")]
    frames = []
    for part in log:
        frames.append(literal(spark, part, "t string, ip_address string").selectExpr("cast(t as timestamp_ntz) as clicked_at", "ip_address"))
        frames[-1].coalesce(1).write.mode("append").parquet(source)
    stream = read_feed(spark, source, frames[0].schema, streaming=True, maxFilesPerTrigger="1")
    assert stream.schema.simpleString() == f"struct<{schema.replace(' ', ':').replace(',:', ',')}>"
    windows = jobs.burst_windows(stream, 2)
    jobs.burst_updates(windows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    found = jobs.stored_bursts(spark, str(tmp_path / "out"), windows.schema, "2026-06-01 10:10:59")
    assert rows(found, "ip_address", "n_clicks", "is_final") == [("a", 3, True), ("b", 2, False)]
    ended = jobs.stored_bursts(spark, str(tmp_path / "out"), windows.schema)
    assert rows(ended, "ip_address", "n_clicks", "is_final") == [("a", 3, True), ("b", 2, True)]
