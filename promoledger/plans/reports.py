"""Business reports. All are lazy DataFrames; sorts are part of the report where the order is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promoledger.functions.predicates import any_of, between, equals_if_given, half_open, live
from promoledger.functions.scalars import MONEY, day_of, descending, percentage, zero_if_null
from promoledger.operators.numbering import number_rows
from promoledger.operators.relational import semi, top_k
from promoledger.session import materialize

BLOCK_ROWS = 200_000


def partner_performance(
    partners: DataFrame, clicks: DataFrame, start, end, partner_ids: Sequence[int] | None = None, ordered: bool = True
) -> DataFrame:
    """Clicks per partner in ``[start, end]`` (both ends included), with the suspicious share.

    Clicks are summed per partner before they meet the partner table: the join sees one row per
    partner, however many clicks one of them drew. Partners without clicks stay, with NULL share.
    """
    window = any_of(clicks.filter(between("clicked_at", start, end)), "partner_id", partner_ids)
    suspicious = F.col("is_suspicious")
    per_partner = window.groupBy("partner_id").agg(
        F.count("click_id").alias("__total"),
        F.count(F.when(~suspicious, F.col("click_id"))).alias("__valid"),
        F.count(F.when(suspicious, F.col("click_id"))).alias("__bad"),
    )
    wanted = any_of(live(partners), "partner_id", partner_ids).select("partner_id", "partner_code", "partner_name")
    # The partner code is unique, so a row per partner is a row per (code, name).
    report = wanted.join(per_partner, "partner_id", "left").select(
        "partner_code",
        "partner_name",
        *[
            F.coalesce(c, F.lit(0)).alias(n)
            for c, n in (("__total", "total_clicks"), ("__valid", "valid_clicks"), ("__bad", "suspicious_clicks"))
        ],
        percentage(F.col("__bad"), F.col("__total")).alias("fraud_rate_pct"),
    )
    return report.orderBy(descending(F.col("total_clicks")), "partner_code") if ordered else report


def _ledger_sums(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("program_id").agg(
        *[
            zero_if_null(F.sum(F.when(F.col("entry_type") == kind, F.col("amount")))).alias(name)
            for kind, name in (("income", "total_income"), ("spend", "actual_spent"))
        ]
    )


def budget_usage(
    programs: DataFrame,
    ledger: DataFrame,
    status_id: int | None = None,
    program_ids: Sequence[int] | None = None,
    merge_same_name: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Budget, income, spend and use per program. Income does not raise what remains.

    The key is the program; ``merge_same_name`` instead merges programs that share name and limit.
    """
    wanted = any_of(equals_if_given(live(programs), "status_id", status_id), "program_id", program_ids)
    sums = _ledger_sums(any_of(live(ledger), "program_id", program_ids))
    joined = wanted.select("program_id", "program_name", "budget_limit").join(sums, "program_id", "left")
    keys = ["program_name", "budget_limit"] if merge_same_name else ["program_id", "program_name", "budget_limit"]
    if merge_same_name:
        joined = joined.groupBy(*keys).agg(F.sum("total_income").alias("total_income"), F.sum("actual_spent").alias("actual_spent"))
    spent = zero_if_null(F.col("actual_spent"))
    report = joined.select(
        *keys,
        zero_if_null(F.col("total_income")).alias("total_income"),
        spent.alias("actual_spent"),
        (F.col("budget_limit") - spent).cast(MONEY).alias("remaining_budget"),
        percentage(spent, F.col("budget_limit")).alias("usage_pct"),
    )
    return report.orderBy(descending(F.col("usage_pct"), nulls_last=True), *keys) if ordered else report


def remaining_budget(programs: DataFrame, ledger: DataFrame, program_id: int | None = None) -> DataFrame:
    """Spent and remaining per program over the whole ledger, soft-deleted entries included."""
    wanted = equals_if_given(programs, "program_id", program_id).select("program_id", "budget_limit")
    sums = _ledger_sums(equals_if_given(ledger, "program_id", program_id)).select("program_id", "actual_spent")
    spent = zero_if_null(F.col("actual_spent"))
    return wanted.join(sums, "program_id", "left").select(
        "program_id", "budget_limit", spent.alias("total_spent"), (F.col("budget_limit") - spent).cast(MONEY).alias("remaining_budget")
    )


def count_by_status(rows: DataFrame, statuses: DataFrame, name: str) -> DataFrame:
    """Live rows per status code: counted per status id first, then joined to the few statuses."""
    counts = live(rows).groupBy("status_id").agg(F.count(F.lit(1)).alias("__n"))
    named = counts.join(statuses.select("status_id", "status_code"), "status_id")
    return named.groupBy("status_code").agg(F.sum("__n").cast("bigint").alias(name)).orderBy("status_code")


def programs_in_status(programs: DataFrame, statuses: DataFrame, code: str, k: int | None = None) -> DataFrame:
    """Live programs in a status, by id; at most ``k`` if given."""
    some = statuses.filter(F.col("status_code") == code).select("status_id", "status_code")
    rows = live(programs).join(some, "status_id").select("program_id", "program_name", "status_code", "budget_limit")
    return rows if k is None else top_k(rows, [F.col("program_id")], k)


def claims_in_status(
    claims: DataFrame, vouchers: DataFrame, statuses: DataFrame, program_id: int, code: str, k: int | None = None
) -> DataFrame:
    """Live claims on a program's vouchers in a status, by id; at most ``k`` if given."""
    some = statuses.filter(F.col("status_code") == code).select("status_id", "status_code")
    own = vouchers.filter(F.col("program_id") == program_id).select("voucher_id", "program_id")
    rows = live(claims).join(own, "voucher_id").join(some, "status_id")
    rows = rows.select(F.col("customer_voucher_id").alias("cv_id"), "status_code", "program_id")
    return rows if k is None else top_k(rows, [F.col("cv_id")], k)


def claim_count(claims: DataFrame, vouchers: DataFrame, program_id: int) -> DataFrame:
    """Number of claims on the vouchers of a program."""
    own = vouchers.filter(F.col("program_id") == program_id).select("voucher_id")
    return semi(claims, own, "voucher_id").agg(F.count(F.lit(1)).alias("claim_count"))


def claim_counts(claims: DataFrame, vouchers: DataFrame) -> DataFrame:
    """The same for every program: claims are counted per voucher before the join."""
    per_voucher = claims.groupBy("voucher_id").agg(F.count(F.lit(1)).alias("__n"))
    joined = vouchers.select("voucher_id", "program_id").join(per_voucher, "voucher_id", "left")
    return joined.groupBy("program_id").agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("claim_count"))


def daily_clicks(clicks: DataFrame, partner_id: int | None = None) -> DataFrame:
    """Clicks per day of one partner, or per partner and day."""
    day = day_of(F.col("clicked_at")).alias("report_day")
    if partner_id is not None:
        rows = clicks.filter(F.col("partner_id") == partner_id)
        return rows.groupBy(day).agg(F.count(F.lit(1)).alias("clicks")).orderBy("report_day")
    return clicks.groupBy("partner_id", day).agg(F.count(F.lit(1)).alias("clicks"))


def recent_clicks(clicks: DataFrame, partner_id: int, k: int) -> DataFrame:
    rows = clicks.filter(F.col("partner_id") == partner_id).select("click_id", "clicked_at")
    return top_k(rows, [F.col("clicked_at").desc(), F.col("click_id").asc()], k)


def click_slice(clicks: DataFrame, partner_id: int, start, end) -> DataFrame:
    """Clicks of one partner in ``[start, end)``."""
    return clicks.filter((F.col("partner_id") == partner_id) & half_open("clicked_at", start, end))


def _with_window(clicks: DataFrame, window: str) -> DataFrame:
    return clicks.withColumn("window_start", F.window("clicked_at", window)["start"])


def bursts(clicks: DataFrame, threshold: int, window: str = "1 minute") -> DataFrame:
    """(ip_address, window start, clicks) wherever one address reaches the threshold in a tumbling window."""
    counts = _with_window(clicks, window).groupBy("ip_address", "window_start").agg(F.count(F.lit(1)).alias("n_clicks"))
    return counts.filter(F.col("n_clicks") >= threshold)


def flag_bursts(clicks: DataFrame, threshold: int, window: str = "1 minute") -> DataFrame:
    """Clicks with ``is_suspicious`` set in every window that reached the threshold.

    The hot windows, at most clicks / threshold of them, are written first: Spark then knows their size
    and broadcasts them without moving the clicks, or falls back to a join it can split on skew.
    """
    hot = materialize(bursts(clicks, threshold, window).select("ip_address", "window_start"), "bursts")
    hot = hot.withColumn("__hot", F.lit(True))
    marked = _with_window(clicks, window).join(hot, ["ip_address", "window_start"], "left")
    flag = F.col("is_suspicious") | F.coalesce(F.col("__hot"), F.lit(False))
    return marked.withColumn("is_suspicious", flag).select(clicks.columns)


def rolling_bursts(
    clicks: DataFrame, threshold: int, window: str = "1 minute", key: str = "ip_address", at: str = "clicked_at", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``clicks`` with ``in_burst``: true for each click of any span shorter than ``window``, wherever it
    begins, that holds ``threshold`` clicks of one address.

    A span is full where the click ``threshold - 1`` places earlier is of the same address and recent
    enough. All clicks are numbered by address and time and cut into blocks of ``block_rows``; each block
    also gets the ``threshold - 1`` neighbours on both sides, so one address may fill any number of blocks
    and no task holds more than a block with its borders. NULL addresses are one address; clicks without a
    time are in no span.
    """
    if threshold < 1:
        raise ValueError("a burst has at least one click")
    reach = threshold - 1
    size = max(block_rows, reach, 1)
    row = clicks.select(F.struct(*[F.col(f"`{c}`") for c in clicks.columns]).alias("__click"), F.col(key).alias("__key"), F.col(at).alias("__at"))
    numbered = number_rows(row, [F.col("__key").asc_nulls_first(), F.col("__at").asc_nulls_first()], "__no")
    block, place = F.floor((F.col("__no") - 1) / size), (F.col("__no") - 1) % size
    near = F.array_compact(F.array(F.lit(0), F.when(place >= size - reach, 1), F.when((place < reach) & (block > 0), -1)))
    spread = numbered.withColumn("__off", F.explode(near)).withColumn("__block", block + F.col("__off"))
    order = Window.partitionBy("__block").orderBy("__no")
    back = F.lag(F.struct("__key", "__at"), reach).over(order) if reach else F.struct("__key", "__at")
    full = F.col("__key").eqNullSafe(F.col("__back.__key")) & (F.col("__at") < F.col("__back.__at") + F.expr(f"INTERVAL {window}"))
    ends = spread.withColumn("__back", back).withColumn("__end", F.col("__back").isNotNull() & F.coalesce(full, F.lit(False)))
    within = F.max("__end").over(order.rowsBetween(Window.currentRow, reach))
    marked = ends.withColumn("in_burst", within).filter(F.col("__off") == 0)
    return marked.select(*[F.col(f"__click.`{c}`").alias(c) for c in clicks.columns], "in_burst")


def quota_alerts(vouchers: DataFrame, ratio: str = "0.9") -> DataFrame:
    """Vouchers of which at least the given share is issued."""
    used = percentage(F.col("total_issued"), F.col("issuance_limit"))
    near = F.col("total_issued").cast("decimal(20,4)") >= F.col("issuance_limit") * F.lit(ratio).cast("decimal(6,4)")
    return vouchers.filter(near).select("voucher_id", "voucher_code", "total_issued", "issuance_limit", used.alias("used_pct"))


def duplicate_payouts(commissions: DataFrame) -> DataFrame:
    """Claims paid more than once under the same rule, with the amount paid beyond the largest."""
    groups = commissions.groupBy("customer_voucher_id", "commission_rule_id").agg(
        F.count(F.lit(1)).alias("n_payouts"),
        zero_if_null(F.sum("commission_amount")).alias("total_amount"),
        zero_if_null(F.max("commission_amount")).alias("largest"),
    )
    excess = (F.col("total_amount") - F.col("largest")).cast(MONEY).alias("excess_amount")
    return groups.filter("n_payouts > 1").select("customer_voucher_id", "commission_rule_id", "n_payouts", "total_amount", excess)


def net_commissions(commissions: DataFrame, adjustments: DataFrame, statuses: DataFrame) -> DataFrame:
    """Commission amounts after approved adjustments."""
    approved = statuses.filter((F.col("status_code") == "APPROVED") & (F.col("entity_type") == "COMMISSION_ADJUSTMENT"))
    counted = adjustments.join(approved.select("status_id"), "status_id", "left_semi")
    sums = counted.groupBy("commission_id").agg(F.sum("amount").alias("__adj"))
    adjusted = zero_if_null(F.col("__adj"))
    return commissions.join(sums, "commission_id", "left").select(
        "commission_id",
        "commission_amount",
        adjusted.alias("adjustment"),
        (F.col("commission_amount") + adjusted).cast(MONEY).alias("net_amount"),
    )


def daily_rollup(clicks: DataFrame) -> DataFrame:
    """Partner x day rollup with the counts the reports need; additive, so days can be refreshed alone."""
    suspicious = F.col("is_suspicious")
    return clicks.groupBy("partner_id", day_of(F.col("clicked_at")).alias("report_day")).agg(
        F.count(F.lit(1)).alias("clicks"),
        F.count(F.when(suspicious, F.lit(1))).alias("suspicious_clicks"),
        F.count(F.when(~suspicious & F.col("reconciliation_status_id").isNull(), F.lit(1))).alias("open_clicks"),
    )


def merge_rollup(rollup: DataFrame, refreshed: DataFrame) -> DataFrame:
    """Replace the refreshed days of a rollup."""
    days = refreshed.select("report_day").distinct()
    return rollup.join(days, "report_day", "left_anti").select(rollup.columns).unionByName(refreshed)
