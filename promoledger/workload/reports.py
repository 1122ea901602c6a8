"""Business reports and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.functions.predicates import month_slice
from promoledger.functions.scalars import MONEY
from promoledger.operators import layout
from promoledger.operators.relational import with_pages
from promoledger.plans import reports
from promoledger.plans.reconcile import reconcile_month, run_reconciliation
from promoledger.plans.sql_functions import register_reports
from promoledger.session import scratch_path
from promoledger.sources.literal import literal
from promoledger.workload.views import AS_OF, pct_sql, sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


_PERFORMANCE = (
    "SELECT p.partner_code, p.partner_name, count(c.click_id) AS total_clicks, "
    "count(c.click_id) FILTER (WHERE NOT c.is_suspicious) AS valid_clicks, "
    "count(c.click_id) FILTER (WHERE c.is_suspicious) AS suspicious_clicks, "
    + pct_sql("count(c.click_id) FILTER (WHERE c.is_suspicious)", "count(c.click_id)")
    + " AS fraud_rate_pct FROM partners p LEFT JOIN clicks c ON p.partner_id = c.partner_id "
    "AND c.clicked_at BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' WHERE p.is_deleted = FALSE"
)


@query(sql(f"{_PERFORMANCE} GROUP BY p.partner_code, p.partner_name", "partners", "clicks"))
def partner_performance(spark, sf):
    return reports.partner_performance(view(spark, sf, "partners"), view(spark, sf, "clicks"), "2024-01-10", "2024-01-20")


@query(sql(f"{_PERFORMANCE} AND p.partner_id = ANY([1, 2, 8]) GROUP BY p.partner_code, p.partner_name", "partners", "clicks"))
def partner_performance_of_some(spark, sf):
    return reports.partner_performance(
        view(spark, sf, "partners"), view(spark, sf, "clicks"), "2024-01-10", "2024-01-20", [1, 2, 8]
    )


@query(
    sql(
        f"SELECT *, row_number() OVER (ORDER BY total_clicks DESC, partner_code) AS row_num, "
        "(row_number() OVER (ORDER BY total_clicks DESC, partner_code) - 1) // 100 AS page "
        f"FROM ({_PERFORMANCE} GROUP BY p.partner_code, p.partner_name)",
        "partners", "clicks",
    )
)
def partner_performance_pages(spark, sf):
    report = reports.partner_performance(
        view(spark, sf, "partners"), view(spark, sf, "clicks"), "2024-01-10", "2024-01-20", ordered=False
    )
    return with_pages(report, [F.col("total_clicks").desc(), F.col("partner_code").asc()], 100)


@query(sql(f"{_PERFORMANCE} AND p.partner_id = ANY([1, 2, 8]) GROUP BY p.partner_code, p.partner_name", "partners", "clicks"))
def partner_performance_sql(spark, sf):
    _register(spark, sf)
    return spark.sql(
        "SELECT * FROM partner_performance_report(timestamp_ntz'2024-01-10', timestamp_ntz'2024-01-20', array(1L, 2L, 8L))"
    )


_SUM = "coalesce(sum(l.amount) FILTER (WHERE l.entry_type = '{}'), 0)"
_USAGE = (
    "SELECT p.program_id, p.program_name, p.budget_limit, CAST({income} AS DECIMAL(18,2)) AS total_income, "
    "CAST({spend} AS DECIMAL(18,2)) AS actual_spent, CAST(p.budget_limit - {spend} AS DECIMAL(18,2)) AS remaining_budget, "
    "{pct} AS usage_pct FROM programs p LEFT JOIN ledger l ON p.program_id = l.program_id AND l.is_deleted = FALSE "
    "WHERE p.is_deleted = FALSE"
).format(income=_SUM.format("income"), spend=_SUM.format("spend"), pct=pct_sql(_SUM.format("spend"), "p.budget_limit"))
_USAGE_KEYS = "GROUP BY p.program_id, p.program_name, p.budget_limit"


@query(sql(f"{_USAGE} {_USAGE_KEYS}", "programs", "ledger"))
def budget_usage(spark, sf):
    return reports.budget_usage(view(spark, sf, "programs"), view(spark, sf, "ledger"))


def _register(spark, sf):
    names = {"partner": "partners", "click": "clicks", "program": "programs", "ledger": "ledger"}
    for source in names.values():
        view(spark, sf, source).createOrReplaceTempView(f"__promoledger_{source}")
    register_reports(spark, **{k: f"__promoledger_{v}" for k, v in names.items()})


@query(sql(f"{_USAGE} AND p.status_id = 15 {_USAGE_KEYS}", "programs", "ledger"))
def budget_usage_sql(spark, sf):
    _register(spark, sf)
    return spark.sql("SELECT * FROM program_budget_usage(status => 15L)")


@query(sql(f"{_USAGE} AND p.status_id = 15 {_USAGE_KEYS}", "programs", "ledger"))
def budget_usage_of_status(spark, sf):
    return reports.budget_usage(view(spark, sf, "programs"), view(spark, sf, "ledger"), status_id=15)


@query(
    sql(
        f"SELECT * EXCLUDE (program_id), row_number() OVER (ORDER BY usage_pct DESC NULLS LAST, program_id) AS row_num, "
        "(row_number() OVER (ORDER BY usage_pct DESC NULLS LAST, program_id) - 1) // 50 AS page, program_id "
        f"FROM ({_USAGE} {_USAGE_KEYS})",
        "programs", "ledger",
    )
)
def budget_usage_pages(spark, sf):
    report = reports.budget_usage(view(spark, sf, "programs"), view(spark, sf, "ledger"), ordered=False)
    return with_pages(report, [F.col("usage_pct").desc_nulls_last(), F.col("program_id").asc()], 50)


@query(
    sql(
        "SELECT brand AS program_name, size_limit AS budget_limit, CAST(coalesce(sum(amount) FILTER (WHERE kind = 'income'), 0) "
        "AS DECIMAL(18,2)) AS total_income, CAST(coalesce(sum(amount) FILTER (WHERE kind = 'spend'), 0) AS DECIMAL(18,2)) AS actual_spent, "
        "CAST(size_limit - coalesce(sum(amount) FILTER (WHERE kind = 'spend'), 0) AS DECIMAL(18,2)) AS remaining_budget, "
        + pct_sql("coalesce(sum(amount) FILTER (WHERE kind = 'spend'), 0)", "size_limit")
        + " AS usage_pct FROM (SELECT p_partkey, p_brand AS brand, CAST(p_size * 1000 AS DECIMAL(18,2)) AS size_limit FROM part) p "
        "LEFT JOIN (SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN 'income' WHEN 'N' THEN 'spend' ELSE 'adjustment' END AS kind, "
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem) l ON l.l_partkey = p.p_partkey GROUP BY brand, size_limit"
    )
)
def budget_usage_merged_names(spark, sf):
    programs = table(spark, sf, "part").selectExpr(
        "p_partkey AS program_id", "p_brand AS program_name", "CAST(p_size * 1000 AS DECIMAL(18,2)) AS budget_limit", "false AS is_deleted"
    )
    ledger = table(spark, sf, "lineitem").selectExpr(
        "l_partkey AS program_id",
        "CASE l_returnflag WHEN 'A' THEN 'income' WHEN 'N' THEN 'spend' ELSE 'adjustment' END AS entry_type",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount",
        "false AS is_deleted",
    )
    return reports.budget_usage(programs, ledger, merge_same_name=True)


@query(
    sql(
        "SELECT p.program_id, p.budget_limit, CAST({s} AS DECIMAL(18,2)) AS total_spent, "
        "CAST(p.budget_limit - {s} AS DECIMAL(18,2)) AS remaining_budget FROM programs p LEFT JOIN ledger l "
        "ON l.program_id = p.program_id GROUP BY p.program_id, p.budget_limit".format(s=_SUM.format("spend")),
        "programs", "ledger",
    )
)
def remaining_budget(spark, sf):
    return reports.remaining_budget(view(spark, sf, "programs"), view(spark, sf, "ledger"))


def _counts_sql(rows: str, name: str) -> str:
    return sql(
        f"SELECT status_code, count(*) AS {name} FROM {rows} r JOIN statuses s ON s.status_id = r.status_id "
        "WHERE r.is_deleted = FALSE GROUP BY status_code",
        rows, "statuses",
    )


@query(_counts_sql("programs", "program_count"))
def programs_by_status(spark, sf):
    return reports.count_by_status(view(spark, sf, "programs"), view(spark, sf, "statuses"), "program_count")


@query(_counts_sql("claims", "cv_count"))
def claims_by_status(spark, sf):
    return reports.count_by_status(view(spark, sf, "claims"), view(spark, sf, "statuses"), "cv_count")


@query(
    sql(
        "SELECT program_id, program_name, status_code, budget_limit FROM programs p JOIN statuses s ON s.status_id = p.status_id "
        "WHERE status_code = 'ACTIVE' AND is_deleted = FALSE ORDER BY program_id LIMIT 3",
        "programs", "statuses",
    )
)
def active_programs(spark, sf):
    return reports.programs_in_status(view(spark, sf, "programs"), view(spark, sf, "statuses"), "ACTIVE", 3)


@query(
    sql(
        "SELECT customer_voucher_id AS cv_id, status_code, v.program_id FROM claims c JOIN vouchers v ON v.voucher_id = c.voucher_id "
        "JOIN statuses s ON s.status_id = c.status_id WHERE v.program_id = 1 AND status_code = 'SAVED' AND is_deleted = FALSE "
        "ORDER BY customer_voucher_id LIMIT 5",
        "claims", "vouchers", "statuses",
    )
)
def saved_claims_of_program(spark, sf):
    return reports.claims_in_status(
        view(spark, sf, "claims"), view(spark, sf, "vouchers"), view(spark, sf, "statuses"), 1, "SAVED", 5
    )


@query(
    sql(
        "SELECT count(*) AS claim_count FROM claims WHERE voucher_id IN (SELECT voucher_id FROM vouchers WHERE program_id = 7)",
        "claims", "vouchers",
    )
)
def claims_of_program(spark, sf):
    return reports.claim_count(view(spark, sf, "claims"), view(spark, sf, "vouchers"), 7)


@query(
    sql(
        "SELECT v.program_id, count(c.customer_voucher_id) AS claim_count FROM vouchers v LEFT JOIN claims c "
        "ON c.voucher_id = v.voucher_id GROUP BY v.program_id",
        "claims", "vouchers",
    )
)
def claims_per_program(spark, sf):
    return reports.claim_counts(view(spark, sf, "claims"), view(spark, sf, "vouchers"))


@query(
    sql("SELECT partner_id, date_trunc('day', clicked_at)::TIMESTAMP AS report_day, count(*) AS clicks FROM clicks GROUP BY ALL", "clicks")
)
def daily_series(spark, sf):
    return reports.daily_clicks(view(spark, sf, "clicks"))


@query(
    sql(
        "SELECT date_trunc('day', clicked_at)::TIMESTAMP AS report_day, count(*) AS clicks FROM clicks WHERE partner_id = 3 GROUP BY ALL",
        "clicks",
    )
)
def daily_series_of_partner(spark, sf):
    return reports.daily_clicks(view(spark, sf, "clicks"), 3)


@query(
    sql("SELECT click_id, clicked_at FROM clicks WHERE partner_id = 3 ORDER BY clicked_at DESC, click_id LIMIT 10", "clicks")
)
def recent_clicks(spark, sf):
    return reports.recent_clicks(view(spark, sf, "clicks"), 3, 10)


@query(
    sql(
        "SELECT click_id, clicked_at, is_suspicious FROM clicks WHERE partner_id IN (1, 2) AND clicked_at >= TIMESTAMP '2024-01-05' "
        "AND clicked_at < TIMESTAMP '2024-01-25'",
        "clicks",
    )
)
def partner_time_slice(spark, sf):
    parts = [reports.click_slice(view(spark, sf, "clicks"), p, "2024-01-05", "2024-01-25") for p in (1, 2)]
    return parts[0].unionByName(parts[1]).select("click_id", "clicked_at", "is_suspicious")


# ---- reconciliation -----------------------------------------------------------------------------

_ELIGIBLE = (
    "clicked_at >= TIMESTAMP '2024-01-01' AND clicked_at < TIMESTAMP '2024-02-01' AND NOT is_suspicious "
    "AND reconciliation_status_id IS NULL"
)
_RATED = "(SELECT partner_id, partner_name, payout_rate FROM partners p JOIN rules r ON p.commission_rule_id = r.commission_rule_id WHERE p.is_deleted = FALSE)"


def _reconciled(spark, sf, clicks=None):
    source = view(spark, sf, "clicks") if clicks is None else clicks
    return reconcile_month(source, view(spark, sf, "partners"), view(spark, sf, "rules"), 2024, 1, AS_OF)


@query(
    sql(
        f"SELECT p.partner_id, p.partner_name, count(c.click_id) AS valid_clicks, p.payout_rate, "
        f"CAST(count(c.click_id) * p.payout_rate AS DECIMAL(18,2)) AS total_payout FROM {_RATED} p LEFT JOIN "
        f"(SELECT * FROM clicks WHERE {_ELIGIBLE}) c ON c.partner_id = p.partner_id GROUP BY p.partner_id, p.partner_name, p.payout_rate",
        "clicks", "partners", "rules",
    )
)
def reconcile_month_payout(spark, sf):
    return _reconciled(spark, sf).report


@query(
    sql(
        "SELECT click_id, partner_id, CAST(CASE WHEN NOT is_suspicious AND reconciliation_status_id IS NULL AND partner_id IN "
        f"(SELECT partner_id FROM {_RATED}) AND clicked_at >= TIMESTAMP '2024-01-01' AND clicked_at < TIMESTAMP '2024-02-01' "
        "THEN 1 ELSE reconciliation_status_id END AS BIGINT) AS reconciliation_status_id FROM clicks",
        "clicks", "partners", "rules",
    )
)
def reconcile_month_marked(spark, sf):
    return _reconciled(spark, sf).marked.select("click_id", "partner_id", "reconciliation_status_id")


@query(
    sql(
        f"SELECT partner_id, partner_name, 0::BIGINT AS valid_clicks, payout_rate, CAST(0 AS DECIMAL(18,2)) AS total_payout FROM {_RATED}",
        "clicks", "partners", "rules",
    )
)
def reconcile_month_rerun(spark, sf):
    return _reconciled(spark, sf, _reconciled(spark, sf).marked).report


@query(
    sql(
        "SELECT click_id, partner_id, CAST(CASE WHEN NOT is_suspicious AND reconciliation_status_id IS NULL AND partner_id IN "
        f"(SELECT partner_id FROM {_RATED}) AND partner_id IN (1, 2, 3) AND clicked_at >= TIMESTAMP '2024-01-01' "
        "AND clicked_at < TIMESTAMP '2024-02-01' THEN 1 ELSE reconciliation_status_id END AS BIGINT) AS reconciliation_status_id FROM clicks",
        "clicks", "partners", "rules",
    )
)
def reconcile_job_some_partners(spark, sf):
    done = reconcile_month(view(spark, sf, "clicks"), view(spark, sf, "partners"), view(spark, sf, "rules"), 2024, 1, AS_OF, [1, 2, 3])
    return done.marked.select("click_id", "partner_id", "reconciliation_status_id")


@query(
    sql(
        f"SELECT p.partner_id, p.partner_name, count(c.click_id) AS valid_clicks, p.payout_rate, CAST(count(c.click_id) * p.payout_rate AS DECIMAL(18,2)) "
        "AS total_payout, '2024-01' AS period, CAST(CASE WHEN p.partner_id IN (1, 2) THEN p.no ELSE p.named + 1 END AS INTEGER) AS run_no FROM "
        f"(SELECT *, count(*) FILTER (WHERE partner_id IN (1, 2)) OVER (ORDER BY partner_id) AS no, count(*) FILTER (WHERE partner_id IN (1, 2)) OVER () AS named FROM {_RATED}) p LEFT JOIN "
        f"(SELECT * FROM clicks WHERE {_ELIGIBLE}) c ON c.partner_id = p.partner_id GROUP BY p.partner_id, p.partner_name, p.payout_rate, p.no, p.named",
        "clicks", "partners", "rules",
    )
)
def reconcile_job_rerun(spark, sf):
    """The stored job for partner 1, once more for partner 1, for partner 2, then for all: each is paid in one run."""
    clicks, payouts = scratch_path(spark, "clicks"), scratch_path(spark, "payouts")
    layout.write_partitioned(view(spark, sf, "clicks"), layout.MonthRange("clicked_at", (2024, 1), (2024, 12)), clicks)
    for asked in ([1], [1], [2], None):
        paid = run_reconciliation(clicks, payouts, view(spark, sf, "partners"), view(spark, sf, "rules"), 2024, 1, AS_OF, asked)
    return paid


@query(
    sql(
        "SELECT DISTINCT partner_id, concat('no live, rated partner ', partner_id) AS error FROM clicks WHERE "
        f"clicked_at >= TIMESTAMP '2024-01-01' AND clicked_at < TIMESTAMP '2024-02-01' AND partner_id NOT IN (SELECT partner_id FROM {_RATED})",
        "clicks", "partners", "rules",
    )
)
def reconcile_month_errors(spark, sf):
    return _reconciled(spark, sf).errors


# ---- fraud, alerts, payouts ---------------------------------------------------------------------


@query(
    sql(
        "SELECT ip_address, date_trunc('hour', clicked_at)::TIMESTAMP AS window_start, count(*) AS n_clicks FROM clicks "
        "GROUP BY ALL HAVING count(*) >= 2",
        "clicks",
    )
)
def fraud_windows(spark, sf):
    return reports.bursts(view(spark, sf, "clicks"), 2, "1 hour")


@query(
    sql(
        "SELECT click_id, is_suspicious OR count(*) OVER (PARTITION BY ip_address, date_trunc('day', clicked_at)) >= 5 AS is_suspicious FROM clicks",
        "clicks",
    )
)
def fraud_flags(spark, sf):
    return reports.flag_bursts(view(spark, sf, "clicks"), 5, "1 day").select("click_id", "is_suspicious")


@query(
    sql(
        "SELECT click_id, ip_address, clicked_at, coalesce(bool_or(full_span) OVER (PARTITION BY ip_address ORDER BY clicked_at, click_id "
        "ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING), FALSE) AS in_burst FROM (SELECT *, clicked_at < lag(clicked_at, 2) OVER "
        "(PARTITION BY ip_address ORDER BY clicked_at, click_id) + INTERVAL 1 HOUR AS full_span FROM clicks)",
        "clicks",
    )
)
def rolling_bursts(spark, sf):
    """Three clicks of one address in any span of an hour, also over the edge of a clock hour."""
    return reports.rolling_bursts(view(spark, sf, "clicks"), 3, "1 hour").select("click_id", "ip_address", "clicked_at", "in_burst")


@query(
    sql(
        "SELECT click_id, coalesce(bool_or(full_span) OVER (ORDER BY clicked_at, click_id ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING), FALSE) AS in_burst "
        "FROM (SELECT *, clicked_at < lag(clicked_at, 19) OVER (ORDER BY clicked_at, click_id) + INTERVAL 1 HOUR AS full_span FROM clicks)",
        "clicks",
    )
)
def rolling_bursts_one_address(spark, sf):
    """All clicks come from one address, which fills many blocks."""
    clicks = view(spark, sf, "clicks").withColumn("ip_address", F.lit("one"))
    return reports.rolling_bursts(clicks, 20, "1 hour", block_rows=1000).select("click_id", "in_burst")


_COUNTED = (
    "(SELECT v.voucher_id, v.voucher_code, v.issuance_limit, CAST(least(v.issuance_limit, v.total_issued + count(a.claim_id)) AS INTEGER) "
    "AS total_issued FROM vouchers v LEFT JOIN arrivals a ON a.voucher_id = v.voucher_id "
    "GROUP BY v.voucher_id, v.voucher_code, v.issuance_limit, v.total_issued)"
)


@query(
    sql(
        f"SELECT voucher_id, voucher_code, total_issued, issuance_limit, {pct_sql('total_issued', 'issuance_limit')} AS used_pct "
        f"FROM {_COUNTED} WHERE total_issued >= 0.9 * issuance_limit",
        "vouchers", "arrivals",
    )
)
def quota_alerts(spark, sf):
    counts = view(spark, sf, "arrivals").groupBy("voucher_id").agg(F.count(F.lit(1)).alias("__n"))
    used = F.least(F.col("issuance_limit"), F.col("total_issued") + F.coalesce("__n", F.lit(0))).cast("int")
    vouchers = view(spark, sf, "vouchers").join(counts, "voucher_id", "left").withColumn("total_issued", used)
    return reports.quota_alerts(vouchers)


_PAID = "SELECT l_orderkey AS claim, CAST(l_linenumber AS BIGINT) AS rule, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem"


@query(
    f"SELECT claim AS customer_voucher_id, rule AS commission_rule_id, count(*) AS n_payouts, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount, "
    f"CAST(sum(amount) - max(amount) AS DECIMAL(18,2)) AS excess_amount FROM ({_PAID}) GROUP BY claim, rule HAVING count(*) > 1"
)
def duplicate_payouts(spark, sf):
    commissions = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("customer_voucher_id"),
        F.col("l_linenumber").cast("bigint").alias("commission_rule_id"),
        F.col("l_extendedprice").cast(MONEY).alias("commission_amount"),
    )
    return reports.duplicate_payouts(commissions)


@query(
    "SELECT o_orderkey AS commission_id, CAST(o_totalprice AS DECIMAL(18,2)) AS commission_amount, "
    "CAST(coalesce(a.amount, 0) AS DECIMAL(18,2)) AS adjustment, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + coalesce(a.amount, 0) "
    "AS DECIMAL(18,2)) AS net_amount FROM orders LEFT JOIN (SELECT l_orderkey, sum(-CAST(l_extendedprice AS DECIMAL(18,2))) AS amount "
    "FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey) a ON a.l_orderkey = o_orderkey"
)
def net_commissions(spark, sf):
    commissions = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("commission_id"), F.col("o_totalprice").cast(MONEY).alias("commission_amount")
    )
    # Returned lines are approved adjustments, the others pending ones.
    status = F.when(F.col("l_returnflag") == "R", F.lit(19)).otherwise(F.lit(18)).cast("bigint")
    adjustments = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("commission_id"), (-F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("amount"), status.alias("status_id")
    )
    statuses = literal(
        spark,
        [(18, "PENDING", "COMMISSION_ADJUSTMENT"), (19, "APPROVED", "COMMISSION_ADJUSTMENT")],
        "status_id bigint, status_code string, entity_type string",
    )
    return reports.net_commissions(commissions, adjustments, statuses)


@query(
    sql(
        "SELECT partner_id, date_trunc('day', clicked_at)::TIMESTAMP AS report_day, count(*) AS clicks, count(*) FILTER (WHERE is_suspicious) "
        "AS suspicious_clicks, count(*) FILTER (WHERE NOT is_suspicious AND reconciliation_status_id IS NULL) AS open_clicks "
        "FROM clicks GROUP BY ALL",
        "clicks",
    )
)
def daily_rollup(spark, sf):
    clicks = view(spark, sf, "clicks")
    rollup = reports.daily_rollup(clicks.withColumn("is_suspicious", F.lit(False)))
    # All days are refreshed from the true flags, as a rerun of the month would.
    fresh = reports.daily_rollup(month_slice(clicks, "clicked_at", 2024, 1))
    return reports.merge_rollup(rollup, fresh)
