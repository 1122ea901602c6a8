"""Inserts, updates, deletes, upserts, numbering, counters and stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.functions.scalars import MONEY
from promoledger.operators import counters, dml
from promoledger.session import scratch_path
from promoledger.sources import feeds
from promoledger.sources.literal import literal
from promoledger.sources.schemas import ACTOR, AS_OF as AS_OF_DEFAULT, NEXT_ID, Col, Table
from promoledger.sources.schemas import BOOL, LONG, TEXT, TIME
from promoledger.sources.snapshots import SnapshotStore
from promoledger.workload.views import AS_OF, sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


# ---- inserts ------------------------------------------------------------------------------------

_SUPPLIER_BOOK = Table(
    "supplier_book",
    (
        Col("entry_id", LONG, True, None, NEXT_ID),
        Col("name", TEXT, True, 100),
        Col("note", TEXT),
        Col("created_at", TIME, True, None, AS_OF_DEFAULT),
        Col("created_by", TEXT, True, 100, ACTOR),
        Col("is_deleted", BOOL, True, None, False),
    ),
    ("entry_id",),
)


@query(
    "SELECT s_suppkey AS entry_id, s_name AS name, CASE WHEN s_acctbal > 0 THEN 'ok' END AS note, TIMESTAMP '2024-02-01 00:00:00' "
    "AS created_at, 'LOADER' AS created_by, FALSE AS is_deleted FROM supplier"
)
def insert_with_defaults(spark, sf):
    rows = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("entry_id"), F.col("s_name").alias("name"), F.when(F.col("s_acctbal") > 0, "ok").alias("note")
    )
    return dml.fill_defaults(rows, _SUPPLIER_BOOK, AS_OF, "LOADER")


@query("SELECT p_partkey, p_brand, p_retailprice FROM part UNION ALL SELECT p_partkey, p_brand, p_retailprice FROM part WHERE p_size > 25")
def copy_rows(spark, sf):
    path = scratch_path(spark, "copy")
    df = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice", "p_size")
    feeds.copy_into(df, path, ["p_partkey", "p_brand", "p_retailprice"])
    feeds.copy_into(df.filter("p_size > 25"), path, ["p_partkey", "p_brand", "p_retailprice"])
    return feeds.read_feed(spark, path, df.drop("p_size").schema)


@query(
    "SELECT (SELECT coalesce(max(c_custkey), 0) FROM customer) + row_number() OVER (ORDER BY s_name, s_suppkey) AS id, s_name AS name FROM supplier"
)
def surrogate_keys(spark, sf):
    batch = table(spark, sf, "supplier").select(F.col("s_name").alias("name"), "s_suppkey")
    target = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    return dml.next_ids(batch, target, "id", [F.col("name"), F.col("s_suppkey")]).select("id", "name")


@query(
    "SELECT n.n_name AS child_name, r.id AS parent_id FROM nation n JOIN (SELECT r_regionkey, 100 + row_number() OVER (ORDER BY r_name) AS id "
    "FROM region) r ON n.n_regionkey = r.r_regionkey"
)
def key_chaining(spark, sf):
    start = table(spark, sf, "region").agg(F.lit(100).alias("parent_id"), F.count(F.lit(1)).alias("__n")).select("parent_id")
    parents = dml.next_ids(table(spark, sf, "region").select("r_name", "r_regionkey"), start, "parent_id", [F.col("r_name")])
    children = table(spark, sf, "nation").select(F.col("n_name").alias("child_name"), F.col("n_regionkey").alias("r_regionkey"))
    return dml.chain_keys(children, parents, ["r_regionkey"], "parent_id").select("child_name", "parent_id")


# ---- updates and deletes ------------------------------------------------------------------------


@query("SELECT o_orderkey, 'X' AS o_orderstatus, TIMESTAMP '2024-02-01 00:00:00' AS updated_at FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 200000")
def update_returning(spark, sf):
    df = table(spark, sf, "orders").withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    condition = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)
    change = dml.update_where(df, condition, {"o_orderstatus": "X"}, {"updated_at": F.lit(AS_OF).cast("timestamp_ntz")})
    return change.changed.select("o_orderkey", "o_orderstatus", "updated_at")


@query(
    sql(
        "SELECT program_id, CAST(CASE WHEN status_id = 15 THEN budget_limit - 5000000 ELSE budget_limit END AS DECIMAL(18,2)) AS budget_limit, "
        "CASE WHEN status_id = 15 THEN concat(program_name, ' (Updated)') ELSE program_name END AS program_name FROM programs",
        "programs",
    )
)
def expression_update(spark, sf):
    change = dml.update_where(
        view(spark, sf, "programs"),
        F.col("status_id") == 15,
        {"budget_limit": F.col("budget_limit") - 5000000, "program_name": F.concat("program_name", F.lit(" (Updated)"))},
    )
    return change.table.select("program_id", "budget_limit", "program_name")


@query("SELECT event_id, event_type FROM events WHERE event_type LIKE 'c%'")
def delete_returning(spark, sf):
    return dml.delete_where(table(spark, sf, "events"), F.col("event_type").like("c%")).changed.select("event_id", "event_type")


@query("SELECT event_id, event_type FROM events WHERE NOT coalesce(nullif(event_type, 'view') = 'click', FALSE)")
def delete_remaining(spark, sf):
    condition = F.nullif(F.col("event_type"), F.lit("view")) == "click"
    return dml.delete_where(table(spark, sf, "events"), condition).table.select("event_id", "event_type")


@query(sql("SELECT voucher_id, issuance_limit, 0::INTEGER AS total_issued FROM vouchers", "vouchers"))
def counter_reset(spark, sf):
    change = dml.update_where(view(spark, sf, "vouchers"), F.col("total_issued") > 0, {"total_issued": 0})
    return change.table.select("voucher_id", "issuance_limit", "total_issued")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL '1 year'")
def retention_delete(spark, sf):
    return dml.retain_since(table(spark, sf, "orders"), "o_orderdate", "2000-01-01", years=1).table.select("o_orderkey", "o_orderdate")


@query(
    "SELECT c_custkey, coalesce(top, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders "
    "WHERE o_orderstatus = 'F' GROUP BY o_custkey) ON o_custkey = c_custkey"
)
def update_from_table(spark, sf):
    source = (
        table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("top"))
    )
    return dml.update_from(table(spark, sf, "customer"), source, ["c_custkey"], {"c_acctbal": "top"}).table.select("c_custkey", "c_acctbal")


@query(
    "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'N' AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO') "
    "THEN 'X' ELSE l_linestatus END AS l_linestatus FROM lineitem"
)
def update_with_semi_join(spark, sf):
    keys = table(spark, sf, "part").filter("p_type = 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    change = dml.update_where_in(table(spark, sf, "lineitem"), keys, ["l_partkey"], {"l_linestatus": "X"}, F.col("l_returnflag") == "N")
    return change.table.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus")


# ---- upserts: two overlapping deliveries of the click log ---------------------------------------

_FIRST = "ts <= TIMESTAMP '2024-01-20'"
_SECOND = "ts >= TIMESTAMP '2024-01-10'"


def _deliveries(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", F.col("value").cast(MONEY).alias("value"))
    second = events.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    again = second.withColumn("value", (F.col("value") * 2).cast(MONEY))
    # The second delivery was cut off and sent twice.
    return events.filter(F.col("ts") <= F.lit("2024-01-20").cast("timestamp_ntz")), again.unionByName(again)


@query(
    f"SELECT event_id, ts, user_id, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE {_FIRST} UNION ALL "
    f"SELECT event_id, ts, user_id, CAST(CAST(value AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) FROM events WHERE {_SECOND} AND NOT ({_FIRST})"
)
def upsert_ignore(spark, sf):
    target, incoming = _deliveries(spark, sf)
    return dml.insert_ignore(target, incoming, ["event_id"]).table


@query(f"SELECT 'first' AS run, count(*) AS inserted FROM events WHERE {_SECOND} AND NOT ({_FIRST}) UNION ALL SELECT 'second', 0")
def upsert_ignore_rerun(spark, sf):
    target, incoming = _deliveries(spark, sf)
    first = dml.insert_ignore(target, incoming, ["event_id"])
    second = dml.insert_ignore(first.table, incoming, ["event_id"])
    runs = [c.changed.agg(F.count(F.lit(1)).alias("inserted")).select(F.lit(n).alias("run"), "inserted") for n, c in (("first", first), ("second", second))]
    return runs[0].unionByName(runs[1])


@query(
    f"SELECT event_id, ts, user_id, CAST(CAST(value AS DECIMAL(18,2)) * CASE WHEN {_SECOND} THEN 2 ELSE 1 END AS DECIMAL(18,2)) AS value, "
    f"CASE WHEN {_FIRST} AND {_SECOND} THEN 'LOADER' END AS updated_by FROM events"
)
def upsert_update(spark, sf):
    target, incoming = _deliveries(spark, sf)
    target = target.withColumn("updated_by", F.lit(None).cast("string"))
    return dml.upsert(target, incoming, ["event_id"], ["value"], [F.col("ts")], {"updated_by": "LOADER"}).table


@query(
    f"SELECT event_id FROM events WHERE {_SECOND}"
)
def insert_conflicts(spark, sf):
    target, incoming = _deliveries(spark, sf)
    return dml.insert_conflicts(target, incoming, ["event_id"])


@query(f"SELECT event_id, ts, user_id, CAST(CAST(value AS DECIMAL(18,2)) * 2 AS DECIMAL(18,2)) AS value FROM events WHERE {_SECOND} AND NOT ({_FIRST})")
def daily_feed_reload(spark, sf):
    target, incoming = _deliveries(spark, sf)
    path = scratch_path(spark, "feed")
    incoming.write.parquet(path)
    return feeds.load_daily(target, feeds.read_feed(spark, path, incoming.schema), "event_id").changed


# ---- counters -----------------------------------------------------------------------------------


@query(
    sql(
        "SELECT a.claim_id, a.voucher_id, a.claimed_at, a.claim_no, coalesce(a.claim_no <= v.issuance_limit - v.total_issued, FALSE) AS granted "
        "FROM (SELECT *, row_number() OVER (PARTITION BY voucher_id ORDER BY claimed_at, claim_id) AS claim_no FROM arrivals) a "
        "LEFT JOIN vouchers v ON v.voucher_id = a.voucher_id",
        "arrivals", "vouchers",
    )
)
def capped_issuance(spark, sf):
    return counters.allocate_capped(
        view(spark, sf, "arrivals"), view(spark, sf, "vouchers"), "voucher_id", [F.col("claimed_at"), F.col("claim_id")]
    )


@query(
    sql(
        "SELECT a.claim_id, a.voucher_id, a.claimed_at, coalesce(a.claim_no <= v.issuance_limit - v.total_issued, FALSE) AS granted "
        "FROM (SELECT *, row_number() OVER (PARTITION BY voucher_id ORDER BY claimed_at, claim_id) AS claim_no FROM arrivals) a "
        "LEFT JOIN vouchers v ON v.voucher_id = a.voucher_id",
        "arrivals", "vouchers",
    )
)
def claim_grants(spark, sf):
    return counters.grant_claims(view(spark, sf, "arrivals"), view(spark, sf, "vouchers"), "voucher_id", ["claimed_at", "claim_id"])


@query(
    sql(
        "SELECT a.voucher_id, count(*) AS claims, least(count(*), greatest(max(v.issuance_limit - v.total_issued), 0)) AS granted "
        "FROM arrivals a JOIN vouchers v ON v.voucher_id = a.voucher_id GROUP BY a.voucher_id",
        "arrivals", "vouchers",
    )
)
def claim_grants_with_ties(spark, sf):
    claims = view(spark, sf, "arrivals").withColumn("day", F.to_date("claimed_at"))
    decided = counters.grant_claims(claims, view(spark, sf, "vouchers"), "voucher_id", ["day"])
    known = decided.join(view(spark, sf, "vouchers").select("voucher_id"), "voucher_id")
    return known.groupBy("voucher_id").agg(F.count(F.lit(1)).alias("claims"), F.count_if("granted").alias("granted"))


@query(
    sql(
        "SELECT v.voucher_id, v.issuance_limit, CAST(v.total_issued + least(count(a.claim_id), v.issuance_limit - v.total_issued) AS INTEGER) AS total_issued "
        "FROM vouchers v LEFT JOIN arrivals a ON a.voucher_id = v.voucher_id GROUP BY v.voucher_id, v.issuance_limit, v.total_issued",
        "arrivals", "vouchers",
    )
)
def capped_issuance_counters(spark, sf):
    quotas = view(spark, sf, "vouchers")
    claims = view(spark, sf, "arrivals")
    decided = counters.grant_claims(claims, quotas, "voucher_id", ["claimed_at", "claim_id"])
    return counters.advance_counters(quotas, decided, "voucher_id").select("voucher_id", "issuance_limit", "total_issued")


@query(
    sql(
        "SELECT a.claim_id, a.voucher_id, a.claimed_at, a.claim_no, a.claim_no <= 400 AS granted FROM (SELECT claim_id, 1::INTEGER AS voucher_id, "
        "claimed_at, row_number() OVER (ORDER BY claimed_at, claim_id) AS claim_no FROM arrivals) a",
        "arrivals",
    )
)
def flash_sale_single_voucher(spark, sf):
    """All claims hit one voucher: the spread form for hot keys."""
    claims = view(spark, sf, "arrivals").withColumn("voucher_id", F.lit(1))
    quota = literal(spark, [(1, 500, 100)], "voucher_id int, issuance_limit int, total_issued int")
    return counters.allocate_capped(claims, quota, "voucher_id", [F.col("claimed_at"), F.col("claim_id")], hot_rows=5000)


@query(
    sql(
        "SELECT claim_id, voucher_id, claimed_at, row_number() OVER (PARTITION BY voucher_id ORDER BY claimed_at, claim_id) <= "
        "CASE WHEN voucher_id = 1 THEN 5000 ELSE 3 END AS granted FROM (SELECT claim_id, claimed_at, "
        "CAST(CASE WHEN voucher_id % 4 = 0 THEN 2 ELSE 1 END AS INTEGER) AS voucher_id FROM arrivals)",
        "arrivals",
    )
)
def flash_sale_grants(spark, sf):
    """A wide and a narrow quota share all claims: the last claim covered comes from counting bins."""
    claims = view(spark, sf, "arrivals").withColumn("voucher_id", F.when(F.col("voucher_id") % 4 == 0, 2).otherwise(1))
    quotas = literal(spark, [(1, 5500, 500), (2, 3, 0)], "voucher_id int, issuance_limit int, total_issued int")
    return counters.grant_claims(claims, quotas, "voucher_id", ["claimed_at", "claim_id"])


@query(
    "SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(18,2)) + coalesce(d, 0) AS DECIMAL(18,2)) AS value FROM part LEFT JOIN "
    "(SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(18,2))) AS d FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey"
)
def apply_increments(spark, sf):
    target = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("value"))
    deltas = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast(MONEY).alias("delta"))
    return counters.apply_increments(target, deltas, "p_partkey", "value", "delta")


@query(
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderdate) THEN 'applied' "
    "ELSE 'conflict' END AS outcome FROM orders"
)
def stale_writes(spark, sf):
    writes = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return counters.first_commit_wins(writes, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_orderkey", "o_custkey", "outcome")


@query("SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey")
def last_write_wins(spark, sf):
    return counters.last_write_wins(table(spark, sf, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey")


@query(
    sql(
        "SELECT p.program_id, CAST(budget_limit + coalesce(s, 0) AS DECIMAL(18,2)) AS atomic_value, CAST(budget_limit + coalesce(l, 0) AS DECIMAL(18,2)) "
        "AS stale_value, CAST(coalesce(s, 0) - coalesce(l, 0) AS DECIMAL(18,2)) AS lost_delta FROM programs p LEFT JOIN (SELECT program_id, sum(amount) AS s, "
        "arg_max(amount, transaction_id) AS l FROM ledger GROUP BY program_id) d ON d.program_id = p.program_id",
        "programs", "ledger",
    )
)
def lost_updates(spark, sf):
    deltas = view(spark, sf, "ledger").select("program_id", "transaction_id", F.col("amount").alias("delta"))
    target = view(spark, sf, "programs").select("program_id", "budget_limit")
    return counters.lost_updates(target, deltas, "program_id", "budget_limit", "delta", "transaction_id")


# ---- stored versions ----------------------------------------------------------------------------


@query(
    sql(
        "SELECT 'pinned' AS reading, count(*) AS n_rows, CAST(sum(budget_limit) AS DECIMAL(18,2)) AS total FROM programs UNION ALL "
        "SELECT 'pinned again', count(*), CAST(sum(budget_limit) AS DECIMAL(18,2)) FROM programs UNION ALL "
        "SELECT 'fresh', count(*), CAST(sum(CASE WHEN status_id = 15 THEN budget_limit - 5000000 ELSE budget_limit END) AS DECIMAL(18,2)) FROM programs",
        "programs",
    )
)
def pinned_snapshot(spark, sf):
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.commit({"programs": view(spark, sf, "programs")})
    pinned = store.pin()
    first = pinned.read("programs")
    change = dml.update_where(first, F.col("status_id") == 15, {"budget_limit": F.col("budget_limit") - 5000000})
    store.commit({"programs": change.table})
    readings = (("pinned", first), ("pinned again", pinned.read("programs")), ("fresh", store.read("programs")))
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("budget_limit").cast(MONEY).alias("total")).select(F.lit(n).alias("reading"), "n_rows", "total")
        for n, df in readings
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "SELECT 'lake' AS place, strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n_rows FROM orders WHERE o_orderdate < TIMESTAMP '1998-10-03' "
    "GROUP BY ALL UNION ALL SELECT 'kept', strftime(o_orderdate, '%Y-%m'), count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-10-03' GROUP BY ALL"
)
def archive_history(spark, sf):
    path = scratch_path(spark, "lake")
    history = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    kept = feeds.archive(history, path, "1999-01-01", 90, "o_orderdate", "o_orderkey", fmt="orc")
    # Started over: nothing is archived twice.
    feeds.archive(history, path, "1999-01-01", 90, "o_orderdate", "o_orderkey", fmt="orc")
    lake = spark.read.format("orc").load(path).withColumn("month", F.col("month").cast("string"))
    stay = kept.withColumn("month", F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM"))
    parts = [df.groupBy("month").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("place"), "month", "n_rows") for n, df in (("lake", lake), ("kept", stay))]
    return parts[0].unionByName(parts[1])
