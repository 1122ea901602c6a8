"""Headline queries, each timed on its second run; prints one JSON line.

BENCH_SF_DIR  directory of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    cores for local mode (default 8)
BENCH_QUERIES comma list to time instead of the headline set; ``all`` times every query
"""

from __future__ import annotations

import json
import os
import time

from promoledger.session import build_session
from promoledger.workload import all_queries

HEADLINE = [
    "partner_performance", "budget_usage", "remaining_budget", "reconcile_month_payout", "reconcile_month_marked", "claims_per_program",
    "daily_series", "recent_clicks", "fraud_flags", "duplicate_payouts", "net_commissions", "distinct_counts", "selectivity",
    "column_profile", "common_values", "upsert_ignore", "upsert_update", "update_with_semi_join", "surrogate_keys", "capped_issuance", "claim_grants",
    "flash_sale_single_voucher", "apply_increments", "stale_writes", "lost_updates", "check_rules", "first_of_key_kept", "foreign_key_check",
    "unit_quarantine", "step_quarantine", "change_capture", "change_capture_from_log", "restore_from_history", "row_policy", "config_visibility",
    "predicate_table", "month_partition_read", "hash_partition_lookup", "report_pages", "streamed_ingest", "streamed_fraud_windows",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = list(queries) if asked == "all" else asked.split(",") if asked else HEADLINE
    seconds = {}
    for name in names:
        # The first run compiles the plan's code; the second is timed.
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
