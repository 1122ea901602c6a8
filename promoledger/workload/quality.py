"""Constraint checks, units of work, change capture and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.functions.scalars import MONEY
from promoledger.operators import audit, cascade, dml, quality
from promoledger.operators.numbering import number_rows
from promoledger.operators.quality import BAD
from promoledger.plans.reconcile import audited_update
from promoledger.session import scratch_path
from promoledger.sources.literal import literal
from promoledger.sources.schemas import TABLES, Check
from promoledger.workload.views import AS_OF, sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


# ---- keys ---------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1")
def uniqueness_probe(spark, sf):
    return quality.duplicate_keys(table(spark, sf, "events"), ["event_type"])


@query(
    "SELECT event_id, event_id = min(event_id) OVER (PARTITION BY user_id, event_type) AS kept FROM events"
)
def first_of_key_kept(spark, sf):
    flagged = quality.flag_rows(table(spark, sf, "events"), {})
    flagged = quality.flag_duplicates(flagged, "uq_user_type", ["user_id", "event_type"], "event_id")
    return flagged.select("event_id", (F.size(BAD) == 0).alias("kept"))


@query(
    "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND user_id IN (SELECT user_id FROM events WHERE ts < TIMESTAMP '2024-01-15' "
    "AND event_type = 'purchase')"
)
def key_taken_in_target(spark, sf):
    events = table(spark, sf, "events")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    existing = events.filter((F.col("ts") < cut) & (F.col("event_type") == "purchase"))
    flagged = quality.flag_taken(quality.flag_rows(events.filter(F.col("ts") >= cut), {}), "uq_user", ["user_id"], existing)
    return quality.split_rows(flagged).rejected.select("event_id")


# ---- row rules ----------------------------------------------------------------------------------

_RULES_SQL = (
    "SELECT 'chk_discount' AS constraint_name, l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_discount <= 0.09) UNION ALL "
    "SELECT 'chk_price', l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_extendedprice > l_quantity * 100) UNION ALL "
    "SELECT 'chk_flag', l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') UNION ALL "
    "SELECT 'not_null', l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE nullif(l_linestatus, 'O') IS NULL"
)


@query(_RULES_SQL)
def check_rules(spark, sf):
    rules = {
        "chk_discount": F.expr("l_discount <= 0.09D"),
        "chk_price": F.expr("l_extendedprice > l_quantity * 100"),
        "chk_flag": F.col("l_returnflag").isin("A", "N"),
        "not_null": F.nullif(F.col("l_linestatus"), F.lit("O")).isNotNull(),
    }
    flagged = quality.flag_rows(table(spark, sf, "lineitem"), rules)
    return quality.violations(flagged, ["l_orderkey", "l_linenumber", "l_partkey"]).drop("detail")


@query(
    "SELECT p_partkey, length(p_name) <= 10 AS fits_text, p_retailprice < 1000 AS fits_number FROM part"
)
def length_and_precision(spark, sf):
    # decimal(5,2) holds three integer digits.
    text = F.col("p_retailprice").cast("decimal(18,2)").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", (F.length("p_name") <= 10).alias("fits_text"), quality.decimal_fits(text, 5, 2).alias("fits_number")
    )


@query(
    sql("SELECT program_id, budget_limit FROM programs WHERE NOT (budget_limit >= 1000)", "programs")
)
def rule_added_later(spark, sf):
    return quality.validate_new_check(view(spark, sf, "programs"), Check("chk_minimum", "budget_limit >= 1000")).select("program_id", "budget_limit")


@query(
    "SELECT event_id FROM events WHERE NOT (event_type IN ('click', 'view', 'purchase') AND value < 100)"
)
def row_level_rejects(spark, sf):
    rules = {"chk_type": F.col("event_type").isin("click", "view", "purchase"), "chk_value": F.col("value") < 100}
    return quality.split_rows(quality.flag_rows(table(spark, sf, "events"), rules)).rejected.select("event_id")


@query("SELECT event_id FROM events WHERE event_type IN ('click', 'view', 'purchase') AND value < 100")
def row_level_accepts(spark, sf):
    rules = {"chk_type": F.col("event_type").isin("click", "view", "purchase"), "chk_value": F.col("value") < 100}
    return quality.split_rows(quality.flag_rows(table(spark, sf, "events"), rules)).valid.select("event_id")


# ---- references ---------------------------------------------------------------------------------


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"
)
def foreign_key_check(spark, sf):
    parents = table(spark, sf, "customer").filter("c_acctbal >= 0")
    flagged = quality.flag_rows(table(spark, sf, "orders"), {})
    flagged = quality.flag_orphans(flagged, "fk_order_customer", ["o_custkey"], parents, ["c_custkey"])
    return quality.split_rows(flagged).rejected.select("o_orderkey", "o_custkey")


_PROGRAM_CHECKS = (
    "SELECT 'chk_budget_limit' AS constraint_name, program_id FROM p WHERE budget_limit < 0 UNION ALL "
    "SELECT 'chk_program_date', program_id FROM p WHERE end_at <= start_at UNION ALL "
    "SELECT 'fk_program_status', program_id FROM p WHERE status_id = 17"
)


@query(
    "WITH p AS (SELECT c_custkey AS program_id, CAST(c_acctbal AS DECIMAL(18,2)) AS budget_limit, TIMESTAMP '2024-01-10' AS start_at, "
    "TIMESTAMP '2024-01-01' + c_nationkey * INTERVAL '1 day' AS end_at, CASE WHEN c_mktsegment = 'MACHINERY' THEN 17 ELSE 15 END AS status_id "
    f"FROM customer) {_PROGRAM_CHECKS}"
)
def declared_constraints(spark, sf):
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("program_id"),
        F.col("c_name").alias("program_name"),
        F.col("c_acctbal").cast(MONEY).alias("budget_limit"),
        F.lit("2024-01-10").cast("timestamp_ntz").alias("start_at"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("c_nationkey"))).alias("end_at"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 17).otherwise(15).cast("bigint").alias("status_id"),
    )
    programs = dml.fill_defaults(rows, TABLES["promotion_program"], AS_OF, "ETL_USER")
    statuses = view(spark, sf, "statuses").filter("NOT is_final")
    flagged = quality.check_table(programs, TABLES["promotion_program"], {"status_master": statuses})
    return quality.violations(flagged, ["program_id"]).select("constraint_name", "program_id")


@query(
    "SELECT 'fk_order_customer' AS constraint_name, c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey IN (SELECT o_custkey FROM orders) "
)
def delete_restricted(spark, sf):
    from promoledger.sources.schemas import Col, ForeignKey, LONG, Table

    parent = Table("customer", (Col("c_custkey", LONG, True),), ("c_custkey",))
    fk = ForeignKey("fk_order_customer", ("o_custkey",), "customer", ("c_custkey",))
    child = Table("orders", (Col("o_orderkey", LONG, True), Col("o_custkey", LONG)), ("o_orderkey",), foreign_keys=(fk,))
    doomed = table(spark, sf, "customer").filter("c_acctbal < 0")
    return quality.delete_blockers(doomed, parent, {"orders": table(spark, sf, "orders")}, {"orders": child})


_GONE_ORDERS = "(SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))"


@query(
    "SELECT 'customer' AS table_name, count(*) AS remaining, sum(c_custkey)::BIGINT AS key_sum FROM customer WHERE NOT coalesce(c_acctbal < 0, FALSE) UNION ALL "
    f"SELECT 'orders', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE o_orderkey NOT IN {_GONE_ORDERS} UNION ALL "
    f"SELECT 'lineitem', count(*), sum(l_orderkey)::BIGINT FROM lineitem WHERE l_orderkey NOT IN {_GONE_ORDERS}"
)
def delete_along_references(spark, sf):
    """Customers in debt go from stored tables, with their orders and order lines before them."""
    from promoledger.sources.schemas import Col, ForeignKey, LONG, Table

    owner = ForeignKey("fk_order_customer", ("o_custkey",), "customer", ("c_custkey",))
    order = ForeignKey("fk_line_order", ("l_orderkey",), "orders", ("o_orderkey",))
    tables = {
        "customer": Table("customer", (Col("c_custkey", LONG, True),), ("c_custkey",)),
        "orders": Table("orders", (Col("o_orderkey", LONG, True), Col("o_custkey", LONG)), ("o_orderkey",), foreign_keys=(owner,)),
        "lineitem": Table("lineitem", (Col("l_orderkey", LONG, True), Col("l_linenumber", LONG, True)), ("l_orderkey", "l_linenumber"), foreign_keys=(order,)),
    }
    paths = {name: scratch_path(spark, f"cascade-{name}") for name in tables}
    for name, path in paths.items():
        table(spark, sf, name).write.parquet(path)
    stored = {name: spark.read.parquet(path) for name, path in paths.items()}
    doomed = cascade.doomed_rows({"customer": stored["customer"].filter("c_acctbal < 0")}, stored, tables)
    cascade.delete_stored(spark, doomed, paths)
    left = None
    for name, path in paths.items():
        first = F.sum(tables[name].key[0]).cast("bigint").alias("key_sum")
        counts = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("remaining"), first).select(F.lit(name).alias("table_name"), "remaining", "key_sum")
        left = counts if left is None else left.unionByName(counts)
    return left


# ---- units of work ------------------------------------------------------------------------------

_BAD_UNIT = (
    "(SELECT l_orderkey FROM lineitem WHERE NOT (l_discount <= 0.095) UNION SELECT o_orderkey FROM orders WHERE NOT (o_totalprice >= 2000))"
)


def _units(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "unit_id")
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "unit_id")
    return {
        "lineitem": quality.flag_rows(lines, {"chk_discount": F.expr("l_discount <= 0.095D")}),
        "orders": quality.flag_rows(orders, {"chk_total": F.expr("o_totalprice >= 2000")}),
    }


@query(
    f"SELECT 'orders' AS part, o_orderkey AS unit_id, 1::BIGINT AS n FROM orders WHERE o_orderkey NOT IN {_BAD_UNIT} UNION ALL "
    f"SELECT 'lineitem', l_orderkey, count(*) FROM lineitem WHERE l_orderkey NOT IN {_BAD_UNIT} GROUP BY l_orderkey"
)
def unit_quarantine(spark, sf):
    split = quality.quarantine_units(_units(spark, sf), "unit_id")
    parts = [
        split[name].valid.groupBy("unit_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "unit_id", "n")
        for name in ("orders", "lineitem")
    ]
    return parts[0].unionByName(parts[1])


@query(f"SELECT l_orderkey AS unit_id, l_linenumber, l_partkey, l_discount FROM lineitem WHERE l_orderkey IN {_BAD_UNIT}")
def unit_quarantine_rejects(spark, sf):
    split = quality.quarantine_units(_units(spark, sf), "unit_id")
    return split["lineitem"].rejected.select("unit_id", "l_linenumber", "l_partkey", "l_discount")


# Attempts: the events of a user are the steps (one per type) in order of their id; a view is required.
_STEPS = (
    "(SELECT *, min(CASE WHEN value >= 20 THEN event_id END) OVER (PARTITION BY user_id, event_type) AS first_ok, "
    "min(CASE WHEN value >= 20 AND event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id) AS view_ok, "
    "max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS has_view FROM events)"
)
_STEP_KEPT = "event_id = first_ok AND (view_ok IS NOT NULL OR has_view = 0)"


def _steps(spark, sf):
    return quality.quarantine_steps(
        table(spark, sf, "events"), "user_id", "event_type", "event_id", F.col("value") >= 20, F.col("event_type") == "view"
    )


@query(f"SELECT event_id, user_id, event_type FROM {_STEPS} WHERE {_STEP_KEPT}")
def step_quarantine(spark, sf):
    return _steps(spark, sf).valid.select("event_id", "user_id", "event_type")


@query(f"SELECT event_id FROM {_STEPS} WHERE NOT coalesce({_STEP_KEPT}, FALSE)")
def step_quarantine_rejects(spark, sf):
    return _steps(spark, sf).rejected.select("event_id")


@query("SELECT user_id, count(DISTINCT event_type) AS present, 5::BIGINT AS expected FROM events WHERE value > 60 GROUP BY user_id HAVING count(DISTINCT event_type) < 5")
def partial_units(spark, sf):
    rows = table(spark, sf, "events").filter("value > 60").withColumnRenamed("event_type", "step")
    return quality.partial_units(rows, "user_id", 5)


# ---- states -------------------------------------------------------------------------------------


def _transition(priority: str) -> str:
    return f"CAST(CASE {priority} WHEN '1-URGENT' THEN 14 WHEN '2-HIGH' THEN 15 WHEN '3-MEDIUM' THEN 16 ELSE 17 END AS BIGINT)"


_TO = "CAST(CASE o_orderstatus WHEN 'F' THEN 15 WHEN 'O' THEN 16 ELSE 17 END AS BIGINT)"


@query(
    f"SELECT o_orderkey, from_status_id, to_status_id, CASE WHEN from_status_id = 17 THEN 'from final status' ELSE 'no such transition' END AS reason "
    f"FROM (SELECT o_orderkey, {_transition('o_orderpriority')} AS from_status_id, {_TO} AS to_status_id FROM orders) WHERE from_status_id = 17 OR "
    "(from_status_id, to_status_id) NOT IN ((14, 15), (15, 16), (16, 15), (15, 17))"
)
def illegal_transitions(spark, sf):
    changes = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "'PROMOTION_PROGRAM' AS entity_type", f"{_transition('o_orderpriority')} AS from_status_id", f"{_TO} AS to_status_id"
    )
    edges = literal(
        spark,
        [("PROMOTION_PROGRAM", a, b) for a, b in ((14, 15), (15, 16), (16, 15), (15, 17))],
        "entity_type string, from_status_id bigint, to_status_id bigint",
    )
    return quality.illegal_transitions(changes, edges, view(spark, sf, "statuses")).drop("entity_type")


@query(
    sql(
        "SELECT customer_voucher_id, status_id FROM (SELECT customer_voucher_id, CAST(CASE WHEN is_deleted THEN 15 ELSE status_id END AS BIGINT) AS status_id "
        "FROM claims) WHERE status_id NOT IN (SELECT status_id FROM statuses WHERE entity_type = 'CUSTOMER_VOUCHER')",
        "claims", "statuses",
    )
)
def wrong_entity_status(spark, sf):
    status = F.when(F.col("is_deleted"), F.lit(15).cast("bigint")).otherwise(F.col("status_id"))
    claims = view(spark, sf, "claims").select("customer_voucher_id", status.alias("status_id"))
    return quality.wrong_entity_status(claims, view(spark, sf, "statuses"), "CUSTOMER_VOUCHER")


# ---- change capture -----------------------------------------------------------------------------
# Old image: customers as they are. New image: BUILDING loses its balance, FURNITURE moves to its own
# nation number (a no-op), MACHINERY is deleted, AUTOMOBILE changes segment.

_NEW = (
    "(SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance, c_nationkey AS nation, "
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'HOUSEHOLD' ELSE c_mktsegment END AS segment, "
    "CASE WHEN c_acctbal > 5000 THEN 'NIGHT_EDITOR' END AS updated_by FROM customer WHERE c_mktsegment <> 'MACHINERY')"
)
_OLD = "(SELECT c_custkey AS id, c_acctbal AS balance, c_nationkey AS nation, c_mktsegment AS segment FROM customer)"
_CHANGED = "o.balance IS DISTINCT FROM n.balance OR o.nation IS DISTINCT FROM n.nation OR o.segment IS DISTINCT FROM n.segment"
_TRACKED = ("balance", "nation", "segment")


def _images(spark, sf):
    customer = table(spark, sf, "customer")
    old = customer.selectExpr("c_custkey AS id", "c_acctbal AS balance", "c_nationkey AS nation", "c_mktsegment AS segment")
    new = customer.filter("c_mktsegment <> 'MACHINERY'").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance",
        "c_nationkey AS nation",
        "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'HOUSEHOLD' ELSE c_mktsegment END AS segment",
        "CASE WHEN c_acctbal > 5000 THEN 'NIGHT_EDITOR' END AS updated_by",
    )
    return old, new


@query(
    "SELECT o.id, o.balance AS old_balance, o.nation AS old_nation, o.segment AS old_segment, TIMESTAMP '2024-02-01 00:00:00' AS changed_at, "
    f"coalesce(n.updated_by, 'SYSTEM') AS changed_by, 'UPDATE' AS change_type FROM {_OLD} o JOIN {_NEW} n ON o.id = n.id WHERE {_CHANGED}"
)
def change_capture(spark, sf):
    old, new = _images(spark, sf)
    return audit.capture_changes(old, new, "id", _TRACKED, AS_OF, "SYSTEM")


@query(f"SELECT row_number() OVER (ORDER BY o.id) AS history_id, o.id, o.balance AS old_balance FROM {_OLD} o JOIN {_NEW} n ON o.id = n.id WHERE {_CHANGED}")
def numbered_history(spark, sf):
    old, new = _images(spark, sf)
    captured = audit.capture_changes(old, new, "id", _TRACKED, AS_OF, "SYSTEM")
    return number_rows(captured, [F.col("id")], "history_id").select("history_id", "id", "old_balance")


@query(f"SELECT o.id, o.balance, o.nation, o.segment FROM {_OLD} o JOIN {_NEW} n ON o.id = n.id")
def restore_from_history(spark, sf):
    old, new = _images(spark, sf)
    captured = audit.capture_changes(old, new, "id", _TRACKED, AS_OF, "SYSTEM").withColumn("history_id", F.col("id"))
    current = new.drop("updated_by")
    return audit.restore(current, captured, "id", _TRACKED, AS_OF, "RESTORE_JOB").table


@query(
    "SELECT o_custkey, o_orderkey AS history_id, o_totalprice FROM orders WHERE o_orderkey IN (SELECT max(o_orderkey) FROM orders GROUP BY o_custkey)"
)
def latest_history(spark, sf):
    history = table(spark, sf, "orders").select("o_custkey", F.col("o_orderkey").alias("history_id"), "o_totalprice")
    return audit.latest_history(history, "o_custkey")


@query("SELECT o_orderkey AS history_id, o_custkey, o_orderdate AS changed_at FROM orders WHERE o_custkey = 100")
def history_lookup(spark, sf):
    history = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("history_id"), "o_custkey", F.col("o_orderdate").alias("changed_at")
    )
    return audit.history_of(history, "o_custkey", 100)


_IMAGE_LOG = (
    "(SELECT *, lag(event_type) OVER w AS old_event_type, lag(event_id) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"
)


def _image_log(spark, sf):
    return table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "props")


@query(
    f"SELECT user_id, old_event_type, ts AS changed_at, props AS changed_by, 'UPDATE' AS change_type FROM {_IMAGE_LOG} WHERE before IS NOT NULL "
    "AND event_type IS DISTINCT FROM old_event_type"
)
def change_capture_from_log(spark, sf):
    return audit.capture_from_images(_image_log(spark, sf), "user_id", ["event_type"], [F.col("ts"), F.col("event_id")], "ts", "props")


@query(
    "SELECT 0::BIGINT AS user_id, old_event_type, ts AS changed_at, props AS changed_by, 'UPDATE' AS change_type FROM (SELECT *, "
    "lag(event_type) OVER (ORDER BY ts, event_id) AS old_event_type FROM events) WHERE old_event_type IS NOT NULL AND event_type <> old_event_type"
)
def change_capture_one_hot_key(spark, sf):
    """Every image belongs to one program: the spread form for hot keys."""
    images = _image_log(spark, sf).withColumn("user_id", F.lit(0).cast("bigint"))
    return audit.capture_from_images(images, "user_id", ["event_type"], [F.col("ts"), F.col("event_id")], "ts", "props", hot_rows=5000)


@query(
    sql(
        "SELECT program_id, CAST(CASE WHEN status_id = 15 AND budget_limit - 1000 >= 0 THEN budget_limit - 1000 ELSE budget_limit END AS DECIMAL(18,2)) "
        "AS budget_limit, CASE WHEN status_id = 15 AND budget_limit - 1000 >= 0 THEN 'AUDITOR' END AS updated_by, CASE WHEN status_id = 15 AND "
        "budget_limit - 1000 >= 0 THEN 1 ELSE 0 END::BIGINT AS n_history, CASE WHEN status_id = 15 AND budget_limit - 1000 < 0 THEN 1 ELSE 0 END::BIGINT "
        "AS n_violations FROM programs",
        "programs",
    )
)
def audited_update_job(spark, sf):
    base = view(spark, sf, "programs").withColumns(
        {"start_at": F.lit("2024-01-01").cast("timestamp_ntz"), "end_at": F.lit("2024-12-31").cast("timestamp_ntz")}
    )
    programs = dml.fill_defaults(base, TABLES["promotion_program"], AS_OF, "ADMIN")
    history = literal(spark, [], TABLES["promotion_program_history"].schema)
    done = audited_update(programs, history, F.col("status_id") == 15, {"budget_limit": F.col("budget_limit") - 1000}, AS_OF, "AUDITOR")
    counts = [
        df.groupBy("program_id").agg(F.count(F.lit(1)).alias(name)) for df, name in ((done.captured, "n_history"), (done.violations, "n_violations"))
    ]
    joined = done.table.select("program_id", "budget_limit", "updated_by")
    for c in counts:
        joined = joined.join(c, "program_id", "left")
    return joined.na.fill(0, ["n_history", "n_violations"])


@query(
    "SELECT CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN strftime(o_orderdate, '%Y-%m') ELSE '__default__' END "
    "AS partition_name, count(*) AS row_count FROM orders WHERE o_orderdate < TIMESTAMP '1990-01-01' OR o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL"
)
def history_partitions_kept(spark, sf):
    from promoledger.operators.layout import MonthRange, drop_months, expired_months, partition_counts, write_partitioned

    rule = MonthRange("changed_at", (1990, 1), (1998, 12))
    history = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").alias("changed_at"))
    path = scratch_path(spark, "history")
    write_partitioned(history, rule, path)
    drop_months(spark, rule, expired_months(rule, "1999-01-15", 12), path)
    stored = spark.read.schema("o_orderkey bigint, changed_at timestamp_ntz, month string").parquet(path)
    return partition_counts(stored, rule)
