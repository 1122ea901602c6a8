"""The parametrised reports as SQL table functions with optional arguments.

They read temporary views of the session (``SnapshotStore.pin().register_views()`` makes them) and
accept positional or named arguments, for example::

    SELECT * FROM partner_performance_report(timestamp_ntz'2026-06-01', timestamp_ntz'2026-06-30', array(1, 2))
    SELECT * FROM program_budget_usage(program_ids => array(1, 2))

An absent list means all rows; an empty one matches none.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_PERCENT = "CAST(round(CAST({part} AS DECIMAL(20,2)) * 100 / nullif(CAST({whole} AS DECIMAL(20,2)), 0), 2) AS DECIMAL(38,2))"

_PARTNER_PERFORMANCE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION partner_performance_report(
    start_at TIMESTAMP_NTZ, end_at TIMESTAMP_NTZ, partner_ids ARRAY<BIGINT> DEFAULT NULL)
RETURNS TABLE (partner_code STRING, partner_name STRING, total_clicks BIGINT, valid_clicks BIGINT,
    suspicious_clicks BIGINT, fraud_rate_pct DECIMAL(38,2))
RETURN
    SELECT p.partner_code, p.partner_name, coalesce(c.total, 0), coalesce(c.good, 0), coalesce(c.bad, 0),
        {_PERCENT.format(part="c.bad", whole="c.total")}
    FROM {{partner}} p
    LEFT JOIN (
        SELECT partner_id, count(click_id) AS total, count(click_id) FILTER (WHERE NOT is_suspicious) AS good,
            count(click_id) FILTER (WHERE is_suspicious) AS bad
        FROM {{click}}
        WHERE clicked_at BETWEEN partner_performance_report.start_at AND partner_performance_report.end_at
        GROUP BY partner_id
    ) c ON c.partner_id = p.partner_id
    WHERE NOT p.is_deleted AND (partner_performance_report.partner_ids IS NULL
        OR array_contains(partner_performance_report.partner_ids, p.partner_id))
"""

_BUDGET_USAGE = f"""
CREATE OR REPLACE TEMPORARY FUNCTION program_budget_usage(
    status BIGINT DEFAULT NULL, program_ids ARRAY<BIGINT> DEFAULT NULL)
RETURNS TABLE (program_id BIGINT, program_name STRING, budget_limit DECIMAL(18,2), total_income DECIMAL(18,2),
    actual_spent DECIMAL(18,2), remaining_budget DECIMAL(18,2), usage_pct DECIMAL(38,2))
RETURN
    SELECT p.program_id, p.program_name, p.budget_limit, CAST(coalesce(l.income, 0) AS DECIMAL(18,2)),
        CAST(coalesce(l.spend, 0) AS DECIMAL(18,2)), CAST(p.budget_limit - coalesce(l.spend, 0) AS DECIMAL(18,2)),
        {_PERCENT.format(part="coalesce(l.spend, 0)", whole="p.budget_limit")}
    FROM {{program}} p
    LEFT JOIN (
        SELECT program_id, sum(amount) FILTER (WHERE entry_type = 'income') AS income,
            sum(amount) FILTER (WHERE entry_type = 'spend') AS spend
        FROM {{ledger}} WHERE NOT is_deleted GROUP BY program_id
    ) l ON l.program_id = p.program_id
    WHERE NOT p.is_deleted AND (program_budget_usage.status IS NULL OR p.status_id = program_budget_usage.status)
        AND (program_budget_usage.program_ids IS NULL OR array_contains(program_budget_usage.program_ids, p.program_id))
"""

_PROFILES = """
CREATE OR REPLACE TEMPORARY FUNCTION customer_profiles_of_region(reader STRING, wanted STRING)
RETURNS TABLE (profile_id BIGINT, full_name STRING, region STRING)
RETURN
    SELECT p.profile_id, p.full_name, p.region
    FROM {profiles} p
    LEFT SEMI JOIN {mapping} m ON m.assigned_region = p.region AND m.username = customer_profiles_of_region.reader
    WHERE p.region = customer_profiles_of_region.wanted
"""


def register_reports(
    spark: SparkSession, partner: str = "partner", click: str = "partner_click", program: str = "promotion_program", ledger: str = "budget_transaction"
) -> None:
    """Define ``partner_performance_report`` and ``program_budget_usage`` over the named views."""
    spark.sql(_PARTNER_PERFORMANCE.format(partner=partner, click=click))
    spark.sql(_BUDGET_USAGE.format(program=program, ledger=ledger))


def register_profile_reader(spark: SparkSession, profiles: str = "customer_profiles", mapping: str = "user_region_mapping") -> None:
    """Define ``customer_profiles_of_region(reader, wanted)``, which applies the reader's row policy."""
    spark.sql(_PROFILES.format(profiles=profiles, mapping=mapping))
