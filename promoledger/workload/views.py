"""The star-schema test tables read as the domain tables.

Each view exists twice: as a DataFrame and as the SQL text the result check runs. Both project the
whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.sources.literal import literal

AS_OF = "2024-02-01 00:00:00"

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

STATUSES = [
    (6, "SAVED", "CUSTOMER_VOUCHER", False),
    (7, "APPLIED", "CUSTOMER_VOUCHER", False),
    (8, "REFUNDED", "CUSTOMER_VOUCHER", True),
    (9, "CANCELLED", "CUSTOMER_VOUCHER", True),
    (14, "DRAFT", "PROMOTION_PROGRAM", False),
    (15, "ACTIVE", "PROMOTION_PROGRAM", False),
    (16, "PAUSED", "PROMOTION_PROGRAM", False),
    (17, "ENDED", "PROMOTION_PROGRAM", True),
]
REGION_USERS = [("da_asia", "ASIA"), ("da_europe", "EUROPE"), ("da_africa", "AFRICA")]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


# ---- domain views as SQL expressions, shared by both sides --------------------------------------

_SELECTS = {
    "partners": (
        "customer",
        "c_custkey AS partner_id, c_name AS partner_code, concat(c_mktsegment, ' ', c_name) AS partner_name, "
        "CAST(c_nationkey AS BIGINT) AS commission_rule_id, c_acctbal < 0 AS is_deleted",
    ),
    "rules": (
        "nation",
        "CAST(n_nationkey AS BIGINT) AS commission_rule_id, n_name AS rule_name, "
        "CAST((n_regionkey + 1) * 1.25 AS DECIMAL(10,2)) AS payout_rate",
    ),
    "clicks": (
        "events",
        "event_id AS click_id, user_id AS partner_id, ts AS clicked_at, event_type = 'error' AS is_suspicious, "
        "CAST(CASE WHEN event_type = 'purchase' THEN 1 END AS BIGINT) AS reconciliation_status_id, "
        "props AS ip_address, event_type, CAST(value AS DECIMAL(18,2)) AS amount",
    ),
    "programs": (
        "customer",
        "c_custkey AS program_id, c_name AS program_name, CAST(c_acctbal AS DECIMAL(18,2)) AS budget_limit, "
        "CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 14 WHEN 'BUILDING' THEN 15 WHEN 'FURNITURE' THEN 16 "
        "WHEN 'HOUSEHOLD' THEN 15 ELSE 17 END AS BIGINT) AS status_id, c_acctbal < 0 AS is_deleted",
    ),
    "ledger": (
        "orders",
        "o_orderkey AS transaction_id, o_custkey AS program_id, CASE o_orderstatus WHEN 'F' THEN 'income' "
        "WHEN 'O' THEN 'spend' ELSE 'adjustment' END AS entry_type, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, "
        "o_orderdate AS created_at, o_orderpriority = '5-LOW' AS is_deleted",
    ),
    "vouchers": (
        "customer",
        "c_custkey AS voucher_id, CAST(c_nationkey AS BIGINT) AS program_id, c_name AS voucher_code, "
        "c_nationkey + 1 AS issuance_limit, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS total_issued",
    ),
    "arrivals": ("events", "event_id AS claim_id, user_id AS voucher_id, ts AS claimed_at"),
    "claims": (
        "orders",
        "o_orderkey AS customer_voucher_id, o_custkey AS voucher_id, CAST(CASE o_orderstatus WHEN 'F' THEN 8 "
        "WHEN 'O' THEN 6 ELSE 7 END AS BIGINT) AS status_id, o_orderdate AS saved_at, "
        "o_orderpriority = '5-LOW' AS is_deleted",
    ),
}


def _statuses_sql() -> str:
    rows = ", ".join(f"({i}, '{c}', '{e}', {str(f).upper()})" for i, c, e, f in STATUSES)
    return (
        "SELECT CAST(status_id AS BIGINT) AS status_id, status_code, entity_type, is_final "
        f"FROM (VALUES {rows}) AS v(status_id, status_code, entity_type, is_final)"
    )


_PROFILES_SQL = (
    "SELECT c_custkey AS profile_id, c_name AS full_name, concat(lower(c_name), '@example.org') AS email, "
    "r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    if name == "statuses":
        return literal(spark, STATUSES, "status_id bigint, status_code string, entity_type string, is_final boolean")
    if name == "mapping":
        return literal(spark, REGION_USERS, "username string, assigned_region string")
    if name == "profiles":
        places = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        rows = table(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        return rows.select(
            F.col("c_custkey").alias("profile_id"),
            F.col("c_name").alias("full_name"),
            F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
            F.col("r_name").alias("region"),
        )
    source, select = _SELECTS[name]
    return table(spark, sf, source).selectExpr(*_split(select))


def _split(select: str) -> list[str]:
    parts, depth, current = [], 0, ""
    for ch in select:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(current.strip())
            current = ""
        else:
            current += ch
    return parts + [current.strip()]


def sql(body: str, *names: str) -> str:
    """``body`` with the named views in front as common table expressions."""
    texts = []
    for name in names:
        if name == "statuses":
            text = _statuses_sql()
        elif name == "mapping":
            rows = ", ".join(f"('{u}', '{r}')" for u, r in REGION_USERS)
            text = f"SELECT * FROM (VALUES {rows}) AS v(username, assigned_region)"
        elif name == "profiles":
            text = _PROFILES_SQL
        else:
            source, select = _SELECTS[name]
            text = f"SELECT {select} FROM {source}"
        texts.append(f"{name} AS ({text})")
    head = f"WITH {', '.join(texts)}" if texts else ""
    rest = body.strip()
    if rest.upper().startswith("WITH "):
        return f"{head}, {rest[5:]}" if head else rest
    return f"{head} {rest}"


def pct_sql(part: str, whole: str) -> str:
    """part * 100 / whole to two places, half away from zero, in exact integer arithmetic."""
    p, w = f"CAST(({part}) * 100 AS HUGEINT)", f"CAST(({whole}) * 100 AS HUGEINT)"
    cents = f"((abs({p}) * 20000 + abs({w})) // (2 * abs({w})))"
    return (
        f"CASE WHEN ({whole}) IS NULL OR ({whole}) = 0 THEN NULL ELSE "
        f"CAST(CAST(sign({p}) * sign({w}) * {cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(38,2)) END"
    )


def ratio_sql(part: str, whole: str, places: int) -> str:
    """part / whole of two counts to ``places``, half up, in exact integer arithmetic."""
    scale = 10**places
    unit = "0." + "0" * (places - 1) + "1"
    return (
        f"CASE WHEN ({whole}) = 0 THEN NULL ELSE CAST(CAST((CAST({part} AS HUGEINT) * {2 * scale} + ({whole})) // "
        f"(2 * ({whole})) AS DECIMAL(18,0)) * {unit} AS DECIMAL(38,{places})) END"
    )
