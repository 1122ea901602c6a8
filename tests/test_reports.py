from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from promoledger.operators import dml
from promoledger.plans import reports
from promoledger.plans.reconcile import reconcile_month, run_reconciliation
from promoledger.sources import folders
from promoledger.sources.literal import literal
from promoledger.sources.schemas import TABLES
from tests.conftest import AS_OF, plan, rows


def ledger(spark, *entries):
    batch = literal(spark, [(n, *e) for n, e in enumerate(entries, 1)], "transaction_id bigint, program_id bigint, entry_type string, amount string, is_deleted boolean")
    return dml.fill_defaults(batch, TABLES["budget_transaction"], AS_OF, "X")


def test_partner_without_clicks_stays_with_null_share(spark, seed):
    clicks = seed["partner_click"].withColumn("is_suspicious", F.col("partner_id") == 2)
    report = reports.partner_performance(seed["partner"], clicks.filter("partner_id <= 2"), "2026-06-01", "2026-06-30")
    got = {r.partner_code: tuple(r)[2:] for r in report.collect()}
    assert got["P001"] == (1, 1, 0, Decimal("0.00")) and got["P002"] == (1, 0, 1, Decimal("100.00")) and got["P005"] == (0, 0, 0, None)


def test_report_bounds_are_inclusive_and_lists_are_optional(seed):
    args = (seed["partner"], seed["partner_click"], AS_OF, AS_OF)
    assert reports.partner_performance(*args).agg(F.sum("total_clicks")).first()[0] == 5
    assert reports.partner_performance(*args, partner_ids=[1, 2]).count() == 2
    assert reports.partner_performance(*args, partner_ids=[]).count() == 0


def test_clicks_are_summed_before_the_join(seed):
    text = reports.partner_performance(seed["partner"], seed["partner_click"], "2026-06-01", "2026-06-30")
    logical = text._jdf.queryExecution().optimizedPlan().toString()
    # Below the join the click side is already an aggregate.
    assert logical.index("Join LeftOuter") < logical.rindex("Aggregate")


def test_budget_usage(spark, seed):
    entries = ledger(spark, (1, "income", "1000", False), (1, "spend", "500000", False), (1, "spend", "7", True), (1, "adjustment", "9", False))
    got = {r.program_id: r for r in reports.budget_usage(seed["promotion_program"], entries).collect()}
    assert (got[1].total_income, got[1].actual_spent, got[1].remaining_budget, got[1].usage_pct) == (
        Decimal("1000.00"), Decimal("500000.00"), Decimal("49500000.00"), Decimal("1.00"))
    assert got[2].actual_spent == 0 and got[2].usage_pct == 0
    assert reports.budget_usage(seed["promotion_program"], entries, status_id=2).isEmpty()
    assert reports.budget_usage(seed["promotion_program"], entries, program_ids=[1, 2]).count() == 2


def test_zero_limit_has_null_usage_and_sorts_last(spark, seed):
    programs = seed["promotion_program"].withColumn("budget_limit", F.when(F.col("program_id") == 2, 0).otherwise(F.col("budget_limit")).cast("decimal(18,2)"))
    got = reports.budget_usage(programs, ledger(spark, (1, "spend", "5", False))).collect()
    assert [r.usage_pct is None for r in got] == [False, False, True]


def test_remaining_budget_counts_deleted_entries(spark, seed):
    programs = seed["promotion_program"]
    assert reports.remaining_budget(programs, ledger(spark, (2, "spend", "1", False)), 1).first().remaining_budget == 50_000_000
    entries = ledger(spark, (1, "spend", "500000", True), (1, "income", "3", False))
    assert reports.remaining_budget(programs, entries, 1).first().remaining_budget == 49_500_000


def test_status_reports(seed):
    statuses = seed["status_master"]
    assert rows(reports.count_by_status(seed["promotion_program"], statuses, "n")) == [("ACTIVE", 3)]
    assert rows(reports.count_by_status(seed["customer_voucher"], statuses, "n")) == [("APPLIED", 5)]
    assert rows(reports.programs_in_status(seed["promotion_program"], statuses, "ACTIVE", 3), "program_id") == [(1,), (2,), (3,)]
    assert rows(reports.claims_in_status(seed["customer_voucher"], seed["voucher"], statuses, 1, "APPLIED", 5), "cv_id") == [(1,), (2,), (4,)]
    assert reports.claim_count(seed["customer_voucher"], seed["voucher"], 1).first()[0] == 3
    assert rows(reports.claim_counts(seed["customer_voucher"], seed["voucher"])) == [(1, 3), (2, 1), (3, 1)]


def test_reconciliation_pays_once(seed):
    args = (seed["partner"], seed["commission_rule"], 2026, 6, AS_OF)
    first = reconcile_month(seed["partner_click"], *args)
    assert {r.partner_id: (r.valid_clicks, str(r.total_payout)) for r in first.report.collect()} == {
        1: (1, "5.00"), 2: (1, "7.00"), 3: (1, "10.00"), 4: (1, "3.00"), 5: (1, "8.00")}
    assert first.marked.filter("reconciliation_status_id = 1 AND reconciled_by = 'SYSTEM_PROCEDURE'").count() == 5
    second = reconcile_month(first.marked, *args)
    assert second.report.agg(F.sum("valid_clicks")).first()[0] == 0
    assert second.marked.exceptAll(first.marked).isEmpty()


def test_reconciliation_of_named_partners(spark, seed):
    partners = seed["partner"].withColumn("is_deleted", F.col("partner_id") == 2)
    done = reconcile_month(seed["partner_click"], partners, seed["commission_rule"], 2026, 6, AS_OF, [1, 2, 77])
    assert rows(done.report, "partner_id", "valid_clicks") == [(1, 1)]
    assert rows(done.errors, "partner_id") == [(2,), (77,)]
    # The clicks of the other partners stay as they are.
    assert rows(done.marked, "partner_id", "reconciliation_status_id") == [(1, 1), (2, None), (3, None), (4, None), (5, None)]


def stored_clicks(seed, tmp_path):
    """Paths of the seed's clicks by month and of the payouts, and the frames the job needs."""
    clicks = seed["partner_click"].withColumn("month", F.date_format(F.col("clicked_at").cast("date"), "yyyy-MM"))
    clicks.write.partitionBy("month").parquet(str(tmp_path / "clicks"))
    return str(tmp_path / "clicks"), str(tmp_path / "payouts"), seed["partner"], seed["commission_rule"]


def test_reconciliation_job_marks_and_pays_once(spark, seed, tmp_path):
    stored = stored_clicks(seed, tmp_path)
    for _ in range(2):  # A rerun pays nothing and keeps the first payout.
        paid = run_reconciliation(*stored, 2026, 6, AS_OF)
        assert paid.agg(F.sum("valid_clicks")).first()[0] == 5 and {r.run_no for r in paid.collect()} == {1}
        assert spark.read.parquet(stored[0]).filter("reconciliation_status_id IS NULL").isEmpty()


def test_reconciliation_job_per_partner(spark, seed, tmp_path):
    stored = stored_clicks(seed, tmp_path)
    for asked in ([1], [1], [2]):
        paid = run_reconciliation(*stored, 2026, 6, AS_OF, asked)
    assert [tuple(map(str, r)) for r in sorted(paid.select("partner_id", "total_payout", "run_no").collect())] == [("1", "5.00", "1"), ("2", "7.00", "2")]
    assert spark.read.parquet(stored[0]).count() == seed["partner_click"].count()


def test_reconciliation_of_nobody_writes_nothing(spark, seed, tmp_path):
    stored = stored_clicks(seed, tmp_path)
    assert run_reconciliation(*stored, 2026, 6, AS_OF, [77]).isEmpty()
    assert not (tmp_path / "payouts").exists()


@pytest.mark.parametrize("step", range(9))
def test_reconciliation_job_survives_a_crash_at_any_step(spark, seed, tmp_path, step, monkeypatch):
    stored = stored_clicks(seed, tmp_path)
    real, calls = folders._path, []

    class Stop(Exception):
        pass

    class Crashing:
        """File system calls of the job; the one numbered ``step`` and all after it do not happen."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            def call(*args):
                if name in ("rename", "delete"):
                    if len(calls) == step:
                        raise Stop
                    calls.append(name)
                return getattr(self.fs, name)(*args)

            return call

    def opened(session, path):
        target = real(session, path)
        system = target.getFileSystem
        target.__dict__["getFileSystem"] = lambda conf: Crashing(system(conf))
        return target

    monkeypatch.setattr(folders, "_path", opened)
    with pytest.raises(Stop):
        run_reconciliation(*stored, 2026, 6, AS_OF, [1])
    monkeypatch.setattr(folders, "_path", real)
    paid = run_reconciliation(*stored, 2026, 6, AS_OF, [2])
    paid = run_reconciliation(*stored, 2026, 6, AS_OF, [1])
    assert [tuple(map(str, r)) for r in sorted(paid.select("partner_id", "total_payout").collect())] == [("1", "5.00"), ("2", "7.00")]
    clicks = spark.read.parquet(stored[0])
    assert clicks.count() == seed["partner_click"].count()
    assert rows(clicks.filter("partner_id <= 2"), "partner_id", "reconciliation_status_id") == [(1, 1), (2, 1)]
    assert not [p.name for f in ("clicks", "payouts/period=2026-06") for p in (tmp_path / f).iterdir() if p.name.startswith(".") and p.is_dir()]


def test_payouts_and_adjustments(spark, seed):
    assert reports.duplicate_payouts(seed["affiliate_commission"]).isEmpty()
    twice = seed["affiliate_commission"].unionByName(seed["affiliate_commission"].filter("commission_id = 3"))
    assert [(r.customer_voucher_id, r.n_payouts, str(r.excess_amount)) for r in reports.duplicate_payouts(twice).collect()] == [(3, 2, "10000.00")]
    net = {r.commission_id: str(r.net_amount) for r in reports.net_commissions(seed["affiliate_commission"], seed["commission_adjustment"], seed["status_master"]).collect()}
    assert net[3] == "0.00" and net[1] == "5000.00"


def test_quota_alert(seed):
    assert reports.quota_alerts(seed["voucher"]).isEmpty()
    near = dml.update_where(seed["voucher"], F.col("voucher_id") == 4, {"total_issued": 450}).table
    assert rows(reports.quota_alerts(near), "voucher_id") == [(4,)]


@pytest.mark.parametrize("year,month", [(2026, 2), (2025, 12)])
def test_month_predicate_reaches_the_scan(spark, tmp_path, year, month):
    from promoledger.functions.predicates import month_bounds, month_slice

    path = str(tmp_path / "t")
    spark.range(10).select(F.lit("2026-02-10").cast("timestamp_ntz").alias("clicked_at"), F.lit("2026-02").alias("month")).write.partitionBy("month").parquet(path)
    part = month_slice(spark.read.parquet(path), "clicked_at", year, month, "month")
    text = plan(part)
    start, end = month_bounds(year, month)
    assert "GreaterThanOrEqual(clicked_at" in text and "LessThan(clicked_at" in text and f"= {year}-{month:02d}" in text
    assert part.count() == (10 if (year, month) == (2026, 2) else 0) and start < end


@pytest.mark.parametrize("block_rows", [1, 7, 1000])
def test_rolling_bursts_against_brute_force(spark, block_rows):
    import random
    from datetime import datetime, timedelta

    rng = random.Random(block_rows)
    start = datetime(2026, 6, 1, 11, 59, 30)
    # Most clicks come from one address.
    data = [(k, rng.choice(["hot"] * 6 + ["a", "b", None]), None if rng.random() < 0.05 else start + timedelta(seconds=rng.randrange(1500)), "x") for k in range(160)]
    clicks = spark.createDataFrame(data, "click_id int, ip_address string, clicked_at timestamp_ntz, __no string")
    for threshold in (1, 2, 5, 9):
        marked = reports.rolling_bursts(clicks, threshold, block_rows=block_rows)
        assert marked.columns == [*clicks.columns, "in_burst"]
        got = {r.click_id: r.in_burst for r in marked.collect()}
        want = {k: False for k, *_ in data}
        for _, ip, at, _ in data:
            span = [k for k, other, t, _ in data if at is not None and t is not None and other == ip and at <= t < at + timedelta(minutes=1)]
            if len(span) >= threshold:
                want |= dict.fromkeys(span, True)
        assert got == want
    assert reports.rolling_bursts(clicks.limit(0), 3).count() == 0
