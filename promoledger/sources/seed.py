"""Literal start rows of the domain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promoledger.operators.dml import fill_defaults
from promoledger.sources.schemas import TABLES
from promoledger.sources.literal import literal

# Status ids and codes, payout rates, budget limits, quotas, the example policy
# configuration and the example region mapping are part of the data contract.
STATUSES = [
    (1, "ACTIVE", "CUSTOMER", False),
    (2, "INACTIVE", "CUSTOMER", True),
    (3, "ACTIVE", "VOUCHER", False),
    (4, "USED", "VOUCHER", False),
    (5, "EXPIRED", "VOUCHER", True),
    (6, "SAVED", "CUSTOMER_VOUCHER", False),
    (7, "APPLIED", "CUSTOMER_VOUCHER", False),
    (8, "REFUNDED", "CUSTOMER_VOUCHER", True),
    (9, "CANCELLED", "CUSTOMER_VOUCHER", True),
    (10, "PENDING", "AFFILIATE_COMMISSION", False),
    (11, "APPROVED", "AFFILIATE_COMMISSION", False),
    (12, "PAID", "AFFILIATE_COMMISSION", True),
    (13, "REJECTED", "AFFILIATE_COMMISSION", True),
    (14, "DRAFT", "PROMOTION_PROGRAM", False),
    (15, "ACTIVE", "PROMOTION_PROGRAM", False),
    (16, "PAUSED", "PROMOTION_PROGRAM", False),
    (17, "ENDED", "PROMOTION_PROGRAM", True),
    (18, "PENDING", "COMMISSION_ADJUSTMENT", False),
    (19, "APPROVED", "COMMISSION_ADJUSTMENT", True),
    (20, "REJECTED", "COMMISSION_ADJUSTMENT", True),
]
TRANSITIONS = [(14, 15), (15, 16), (16, 15), (15, 17)]
PAYOUT_RATES = [(1, "5"), (2, "7"), (3, "10"), (4, "3"), (5, "8")]
PROGRAMS = [
    (1, "50000000", "2026-01-01", "2026-02-28"),
    (2, "70000000", "2026-06-01", "2026-08-31"),
    (3, "100000000", "2026-11-01", "2026-11-30"),
]
VOUCHERS = [
    (1, 1, "V001", "AMOUNT", "50000", 1000, 125),
    (2, 1, "V002", "PERCENT", "10", 5000, 350),
    (3, 2, "V003", "PERCENT", "15", 3000, 500),
    (4, 3, "V004", "AMOUNT", "100000", 500, 50),
]
CLAIMS = [(1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 4, 1), (5, 5, 4)]
COMMISSIONS = [(1, 12, "5000"), (2, 12, "7000"), (3, 10, "10000"), (4, 11, "3000"), (5, 13, "8000")]
ADJUSTMENTS = [(1, 3, "-10000", 19)]
REGIONS = ["NORTH", "SOUTH", "CENTRAL"]
REGION_MAPPING = [("da_north", "NORTH"), ("da_south", "SOUTH")]
POLICY_CONFIG = [
    ("U03", "PurchaseOrder", "VendorId", "VS04,UK8A"),
    ("U03", "PurchaseOrder", "PlantID", "W1,W4"),
    ("U03", "PurchaseOrder", "DeliveryMethodName", "%sea%,air%"),
    ("U03", "ProductCategory", "CategoryName", "OLED"),
    ("U31", "*", "*", "*"),
    ("U05", "PurchaseOrder", "*", "*"),
    ("U09", "Customer", "PostalCityID", "1,6,7,3"),
    ("U09", "Customer", "CustomerCategoryName", "%Suspects%,Loyal%,%Referral"),
    ("U09", "Customer", "DeliveryCityID", "*"),
    ("U15", "Invoice", "CustomerCategoryName", "%boxes"),
    ("UE1", "SaleOrder", "CustomerID", "%123"),
    ("UE1", "SaleOrderDetail", "ProductID", "143,F35"),
    ("ADV", "*", "DeliveryMethodName", "Road%,%Rail"),
    ("ADV", "*", "VendorId", "VP19,UB55"),
]
# End of fixed values. Names, addresses and the like below are made up from the row number.


def seed_rows(as_of: str) -> dict[str, tuple[str, list[tuple]]]:
    """Table -> (column list as DDL, rows) with only the columns a seed gives."""
    return {
        "status_master": (
            "status_id bigint, status_code string, status_name string, entity_type string, is_final boolean",
            [(i, code, code.capitalize(), entity, final) for i, code, entity, final in STATUSES],
        ),
        "status_transition": (
            "transition_id bigint, entity_type string, from_status_id bigint, to_status_id bigint",
            [(n, "PROMOTION_PROGRAM", a, b) for n, (a, b) in enumerate(TRANSITIONS, 1)],
        ),
        "commission_rule": (
            "commission_rule_id bigint, rule_name string, payout_rate string",
            [(i, f"Rule {i}", rate) for i, rate in PAYOUT_RATES],
        ),
        "partner": (
            "partner_id bigint, partner_code string, partner_name string, commission_rule_id bigint",
            [(i, f"P{i:03d}", f"Partner {i}", i) for i in range(1, 6)],
        ),
        "promotion_program": (
            "program_id bigint, program_name string, budget_limit string, start_at string, end_at string, status_id bigint",
            [(i, f"Program {i}", limit, start, end, 15) for i, limit, start, end in PROGRAMS],
        ),
        "voucher": (
            "voucher_id bigint, program_id bigint, status_id bigint, voucher_code string, discount_type string, "
            "discount_amount string, issuance_limit int, total_issued int, valid_from string, expired_at string",
            [
                (i, p, 3, code, kind, amount, limit, issued, PROGRAMS[p - 1][2], PROGRAMS[p - 1][3])
                for i, p, code, kind, amount, limit, issued in VOUCHERS
            ],
        ),
        "customer": (
            "customer_id bigint, first_name string, middle_name string, last_name string, phone_number string, "
            "email string, status_id bigint",
            [(i, f"First {i}", "", f"Last {i}", f"000000000{i}", f"c{i}@example.org", 1) for i in range(1, 6)],
        ),
        "partner_click": (
            "click_id string, partner_id bigint, partner_code string, ip_address string, clicked_at string",
            [(f"CLICK{i:03d}", i, f"P{i:03d}", f"192.0.2.{i}", as_of) for i in range(1, 6)],
        ),
        "customer_voucher": (
            "customer_voucher_id bigint, customer_id bigint, voucher_id bigint, click_id string, partner_id bigint, "
            "order_external_code string, status_id bigint, saved_at string, applied_at string",
            [(i, c, v, f"CLICK{i:03d}", i, f"ORD{i:05d}", 7, as_of, as_of) for i, c, v in CLAIMS],
        ),
        "affiliate_commission": (
            "commission_id bigint, customer_voucher_id bigint, commission_rule_id bigint, status_id bigint, "
            "payout_rate string, commission_amount string",
            [(i, i, i, s, rate, amount) for (i, s, amount), (_, rate) in zip(COMMISSIONS, PAYOUT_RATES)],
        ),
        "commission_adjustment": (
            "adjustment_id bigint, commission_id bigint, amount string, reason string, status_id bigint",
            [(i, c, amount, "refund", s) for i, c, amount, s in ADJUSTMENTS],
        ),
        "customer_profiles": (
            "profile_id int, full_name string, email string, phone_number string, region string",
            [
                (r * 15 + n, f"Profile {r * 15 + n}", f"p{r * 15 + n}@example.org", f"01{r * 15 + n:08d}", region)
                for r, region in enumerate(REGIONS)
                for n in range(1, 16)
            ],
        ),
        "user_region_mapping": ("username string, assigned_region string", REGION_MAPPING),
        "t_config_rls": ("user_id string, table_name string, field_name string, value string", POLICY_CONFIG),
    }


def seed_frames(spark: SparkSession, as_of: str, actor: str = "SYSTEM") -> dict[str, DataFrame]:
    """The start rows with declared types and defaults."""
    frames = {
        name: fill_defaults(literal(spark, rows, ddl), TABLES[name], as_of, actor)
        for name, (ddl, rows) in seed_rows(as_of).items()
    }
    for name in ("budget_transaction", "promotion_program_history"):
        frames[name] = literal(spark, [], TABLES[name].schema)
    return frames
