"""Filters, projections, joins, aggregates, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.functions.predicates import (
    all_of, any_of, between, contains_percent, equals_if_given, half_open, holds, live, month_slice,
)
from promoledger.functions.scalars import (
    MONEY, day_of, descending, distinct_from, first_element, list_length, month_of, or_default, percentage, split_list,
    zero_if_null,
)
from promoledger.operators import profile
from promoledger.operators.numbering import number_rows
from promoledger.operators.relational import (
    after_key, blocked_parents, left_with_condition, lookup, missing_parents, semi, top_k, with_pages,
)
from promoledger.workload.views import pct_sql, ratio_sql, sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


# ---- projections and predicates -----------------------------------------------------------------


@query("SELECT * FROM events")
def base_scan(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


@query(
    "SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) "
    "- CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net, concat(l_returnflag, '-', l_linestatus) AS flags, "
    "CASE WHEN l_discount > 0.05 THEN 'high' ELSE 'low' END AS discount_class FROM lineitem"
)
def projection_arithmetic(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        (F.col("l_extendedprice").cast(MONEY) - F.col("l_tax").cast(MONEY)).cast(MONEY).alias("net"),
        F.concat("l_returnflag", F.lit("-"), "l_linestatus").alias("flags"),
        F.when(F.col("l_discount") > 0.05, "high").otherwise("low").alias("discount_class"),
    )


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def equality_filter(spark, sf):
    df = table(spark, sf, "orders")
    return df.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_custkey")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def in_list_filter(spark, sf):
    return table(spark, sf, "events").filter(F.col("event_type").isin("click", "purchase")).select("event_id", "event_type")


@query(
    "SELECT p_partkey, p_name, p_name LIKE 'red%' AS is_prefix, p_name LIKE '%bolt' AS is_suffix, "
    "p_name LIKE '%l%' AS is_infix, contains(p_name, '%') AS has_percent FROM part "
    "WHERE p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_name LIKE '%l%'"
)
def like_filters(spark, sf):
    name = F.col("p_name")
    prefix, suffix, infix = name.like("red%"), name.like("%bolt"), name.like("%l%")
    rows = table(spark, sf, "part").filter(prefix | suffix | infix)
    return rows.select(
        "p_partkey", "p_name", prefix.alias("is_prefix"), suffix.alias("is_suffix"), infix.alias("is_infix"),
        contains_percent(name).alias("has_percent"),
    )


@query(sql("SELECT partner_id, partner_code FROM partners WHERE is_deleted = FALSE", "partners"))
def soft_delete_filter(spark, sf):
    return live(view(spark, sf, "partners")).select("partner_id", "partner_code")


@query("SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'")
def between_filter(spark, sf):
    return table(spark, sf, "events").filter(between("ts", "2024-01-10", "2024-01-20")).select("event_id", "ts")


@query(
    "SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem "
    "WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-06-01'"
)
def half_open_filter(spark, sf):
    rows = table(spark, sf, "lineitem").filter(half_open("l_shipdate", "1998-03-01", "1998-06-01"))
    return rows.select("l_orderkey", "l_partkey", "l_shipdate")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45")
def greater_filter(spark, sf):
    return table(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    sql(
        "SELECT partner_id, count(*) FILTER (WHERE reconciliation_status_id IS NULL) AS open_clicks, "
        "count(*) FILTER (WHERE reconciliation_status_id IS NOT NULL) AS closed_clicks FROM clicks GROUP BY partner_id",
        "clicks",
    )
)
def null_tests(spark, sf):
    status = F.col("reconciliation_status_id")
    return view(spark, sf, "clicks").groupBy("partner_id").agg(
        F.count(F.when(status.isNull(), 1)).alias("open_clicks"), F.count(F.when(status.isNotNull(), 1)).alias("closed_clicks")
    )


@query("SELECT 'given' AS call, count(*) AS n FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'absent', count(*) FROM orders")
def optional_parameter(spark, sf):
    df = table(spark, sf, "orders")
    parts = [
        equals_if_given(df, "o_orderstatus", value).agg(F.count(F.lit(1)).alias("n")).select(F.lit(call).alias("call"), "n")
        for call, value in (("given", "O"), ("absent", None))
    ]
    return parts[0].unionByName(parts[1])


@query(
    "SELECT 'listed' AS call, count(*) AS n FROM customer WHERE c_mktsegment = ANY(['BUILDING', 'MACHINERY']) "
    "UNION ALL SELECT 'empty', count(*) FROM customer WHERE FALSE UNION ALL SELECT 'absent', count(*) FROM customer"
)
def array_membership(spark, sf):
    df = table(spark, sf, "customer")
    calls = (("listed", ["BUILDING", "MACHINERY"]), ("empty", []), ("absent", None))
    parts = [
        any_of(df, "c_mktsegment", values).agg(F.count(F.lit(1)).alias("n")).select(F.lit(call).alias("call"), "n")
        for call, values in calls
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "SELECT event_id, nullif(event_type, 'view') AS before_type, nullif(event_type, 'click') AS after_type FROM events "
    "WHERE nullif(event_type, 'view') IS DISTINCT FROM nullif(event_type, 'click')"
)
def null_safe_difference(spark, sf):
    before = F.nullif(F.col("event_type"), F.lit("view"))
    after = F.nullif(F.col("event_type"), F.lit("click"))
    rows = table(spark, sf, "events").filter(distinct_from(before, after))
    return rows.select("event_id", before.alias("before_type"), after.alias("after_type"))


@query("SELECT event_id FROM events WHERE nullif(event_type, 'view') != 'error'")
def inequality_filter(spark, sf):
    return table(spark, sf, "events").filter(F.nullif(F.col("event_type"), F.lit("view")) != "error").select("event_id")


@query("SELECT (SELECT count(*) FROM part WHERE 1=1) AS allowed, (SELECT count(*) FROM part WHERE 1=0) AS denied")
def constant_predicates(spark, sf):
    df = table(spark, sf, "part")
    return df.agg(F.count(F.when(F.lit(True), 1)).alias("allowed"), F.count(F.when(F.lit(False), 1)).alias("denied"))


@query(
    "SELECT EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 400000) AS has_large, "
    "EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS has_negative"
)
def exists_guard(spark, sf):
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").agg(
        holds(F.bool_or(price > 400000)).alias("has_large"), holds(F.bool_or(price < 0)).alias("has_negative")
    )


@query(
    "SELECT o_orderkey, o_orderdate FROM orders WHERE extract(MONTH FROM o_orderdate) = 2 AND extract(YEAR FROM o_orderdate) = 1997"
)
def calendar_month(spark, sf):
    return month_slice(table(spark, sf, "orders"), "o_orderdate", 1997, 2).select("o_orderkey", "o_orderdate")


@query(
    sql(
        "SELECT DISTINCT c.partner_id FROM clicks c LEFT JOIN (SELECT partner_id FROM partners WHERE is_deleted = FALSE) p "
        "ON c.partner_id = p.partner_id WHERE p.partner_id IS NULL",
        "clicks", "partners",
    )
)
def not_found_report(spark, sf):
    asked = view(spark, sf, "clicks").select("partner_id").distinct()
    return asked.join(live(view(spark, sf, "partners")).select("partner_id"), "partner_id", "left_anti")


# ---- joins --------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_two_tables(spark, sf):
    joined = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "c_name", "n_name")


@query(
    "SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'P'"
)
def join_three_tables(spark, sf):
    orders = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    people = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(people, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name")


@query(
    sql(
        "SELECT program_id, sum(coalesce(n, 0))::BIGINT AS entries FROM (SELECT p.program_id, CASE WHEN l.transaction_id "
        "IS NOT NULL THEN 1 END AS n FROM programs p LEFT JOIN ledger l ON l.program_id = p.program_id AND "
        "l.is_deleted = FALSE) GROUP BY program_id",
        "programs", "ledger",
    )
)
def left_join_flag_in_on(spark, sf):
    ledger = view(spark, sf, "ledger").filter(~F.col("is_deleted")).groupBy("program_id").agg(F.count(F.lit(1)).alias("__n"))
    joined = left_with_condition(view(spark, sf, "programs"), ledger, "program_id", F.lit(True))
    return joined.select("program_id", F.coalesce("__n", F.lit(0)).cast("bigint").alias("entries"))


@query(
    "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)"
)
def semi_join(spark, sf):
    poor = table(spark, sf, "supplier").filter("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return semi(table(spark, sf, "lineitem"), poor, "l_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "SELECT o_custkey, o_orderkey, o_totalprice FROM orders o WHERE o_orderkey = "
    "(SELECT max(o_orderkey) FROM orders i WHERE i.o_custkey = o.o_custkey)"
)
def latest_row_per_key(spark, sf):
    newest = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderkey").alias("o_orderkey"), F.max_by("o_totalprice", "o_orderkey").alias("o_totalprice")
    )
    return newest


@query(
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN "
    "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"
)
def missing_parent_rows(spark, sf):
    kept = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    return missing_parents(table(spark, sf, "orders"), ["o_custkey"], kept, ["c_custkey"]).select("o_orderkey", "o_custkey")


@query(
    "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R')"
)
def blocked_parent_rows(spark, sf):
    doomed = table(spark, sf, "supplier").filter("s_acctbal < 0")
    child = table(spark, sf, "lineitem").filter("l_returnflag = 'R'")
    return blocked_parents(doomed, ["s_suppkey"], child, ["l_suppkey"]).select("s_suppkey", "s_name")


@query(
    sql(
        "SELECT o_orderkey, s.status_id FROM orders LEFT JOIN statuses s ON s.entity_type = 'CUSTOMER_VOUCHER' AND "
        "s.status_code = CASE o_orderstatus WHEN 'F' THEN 'REFUNDED' WHEN 'O' THEN 'SAVED' ELSE 'UNKNOWN' END",
        "statuses",
    )
)
def status_lookup(spark, sf):
    code = F.when(F.col("o_orderstatus") == "F", "REFUNDED").when(F.col("o_orderstatus") == "O", "SAVED").otherwise("UNKNOWN")
    rows = table(spark, sf, "orders").select("o_orderkey", code.alias("code"), F.lit("CUSTOMER_VOUCHER").alias("entity"))
    found = lookup(rows, view(spark, sf, "statuses"), {"code": "status_code", "entity": "entity_type"}, {"status_id": "status_id"})
    return found.select("o_orderkey", "status_id")


# ---- aggregates ---------------------------------------------------------------------------------


@query("SELECT count(*) AS total_rows FROM lineitem")
def global_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("total_rows"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def group_count(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    sql(
        "SELECT partner_id, count(reconciliation_status_id) AS closed, count(click_id) FILTER (WHERE is_suspicious) AS suspicious, "
        "CAST(coalesce(sum(amount) FILTER (WHERE event_type = 'purchase'), 0) AS DECIMAL(18,2)) AS purchased "
        "FROM clicks GROUP BY partner_id",
        "clicks",
    )
)
def conditional_aggregates(spark, sf):
    return view(spark, sf, "clicks").groupBy("partner_id").agg(
        F.count("reconciliation_status_id").alias("closed"),
        F.count(F.when(F.col("is_suspicious"), F.col("click_id"))).alias("suspicious"),
        zero_if_null(F.sum(F.when(F.col("event_type") == "purchase", F.col("amount")))).alias("purchased"),
    )


@query(
    sql(
        "SELECT count(DISTINCT partner_id) AS cardinality_partner_id, count(DISTINCT is_suspicious) AS cardinality_is_suspicious, "
        "count(DISTINCT reconciliation_status_id) AS cardinality_reconciliation_status_id, "
        "count(DISTINCT click_id) AS cardinality_click_id, count(*) AS total_rows FROM clicks",
        "clicks",
    )
)
def distinct_counts(spark, sf):
    return profile.cardinalities(
        view(spark, sf, "clicks"), ["partner_id", "is_suspicious", "reconciliation_status_id", "click_id"]
    )


@query("SELECT coalesce(max(o_orderkey), 1) AS last_id FROM orders")
def scalar_max(spark, sf):
    return table(spark, sf, "orders").agg(or_default(F.max("o_orderkey"), F.lit(1)).cast("bigint").alias("last_id"))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS report_day, count(*) AS n FROM events GROUP BY 1 ORDER BY 1")
def group_by_ordinal(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("__promoledger_events")
    return spark.sql(
        "SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) AS report_day, count(*) AS n FROM __promoledger_events GROUP BY 1 ORDER BY 1"
    )


@query(
    f"SELECT l_suppkey, {pct_sql('count(*) FILTER (WHERE l_returnflag = $$R$$)'.replace('$$', chr(39)), 'count(*)')} AS returned_pct, "
    f"{pct_sql('count(*)', 'count(*) FILTER (WHERE l_quantity > 1000)')} AS guarded FROM lineitem GROUP BY l_suppkey"
)
def guarded_percentage(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("r"),
        F.count(F.when(F.col("l_quantity") > 1000, 1)).alias("z"),
    )
    return counts.select(
        "l_suppkey", percentage(F.col("r"), F.col("n")).alias("returned_pct"), percentage(F.col("n"), F.col("z")).alias("guarded")
    )


@query(
    f"SELECT {ratio_sql('count(*) FILTER (WHERE user_id = 3)', 'count(*)', 4)} AS selectivity_user_3, "
    f"{ratio_sql('count(*) FILTER (WHERE event_type = ' + chr(39) + 'error' + chr(39) + ')', 'count(*)', 4)} AS selectivity_error, "
    f"{ratio_sql('count(*) FILTER (WHERE event_id = 1234)', 'count(*)', 8)} AS selectivity_single_key FROM events"
)
def selectivity(spark, sf):
    return profile.selectivities(
        table(spark, sf, "events"),
        {
            "selectivity_user_3": (F.col("user_id") == 3, 4),
            "selectivity_error": (F.col("event_type") == "error", 4),
            "selectivity_single_key": (F.col("event_id") == 1234, 8),
        },
    )


@query(
    "SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS pending_orders, "
    "(SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS returned_lines"
)
def scalar_counts_row(spark, sf):
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'P'").agg(F.count(F.lit(1)).alias("pending_orders"))
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").agg(F.count(F.lit(1)))
    return pending.select("pending_orders", returned.scalar().alias("returned_lines"))


@query(
    "SELECT p_brand, p_size, count(*) AS n, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total "
    "FROM part GROUP BY p_brand, p_size"
)
def group_by_two_columns(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand", "p_size").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("p_retailprice").cast(MONEY)).cast(MONEY).alias("total")
    )


# ---- sorts, limits, pages -----------------------------------------------------------------------


@query("SELECT o_orderpriority, o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) AS position FROM orders")
def multi_key_sort(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey")
    return number_rows(rows, [F.col("o_orderpriority"), F.col("o_orderkey")], "position")


@query(
    sql(
        "SELECT click_id, reconciliation_status_id, row_number() OVER (ORDER BY reconciliation_status_id DESC NULLS FIRST, click_id) AS position FROM clicks",
        "clicks",
    )
)
def descending_nulls_first(spark, sf):
    rows = view(spark, sf, "clicks").select("click_id", "reconciliation_status_id")
    return number_rows(rows, [descending(F.col("reconciliation_status_id")), F.col("click_id")], "position")


@query(
    sql(
        "SELECT click_id, reconciliation_status_id, row_number() OVER (ORDER BY reconciliation_status_id DESC NULLS LAST, click_id) AS position FROM clicks",
        "clicks",
    )
)
def descending_nulls_last(spark, sf):
    rows = view(spark, sf, "clicks").select("click_id", "reconciliation_status_id")
    return number_rows(rows, [descending(F.col("reconciliation_status_id"), nulls_last=True), F.col("click_id")], "position")


@query("SELECT s_suppkey, s_nationkey FROM supplier ORDER BY s_suppkey LIMIT 5")
def limit_by_key(spark, sf):
    return top_k(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), [F.col("s_suppkey")], 5)


@query(
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' ORDER BY o_orderkey LIMIT 3"
)
def topk_after_join(spark, sf):
    some = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    rows = table(spark, sf, "orders").join(some, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")
    return top_k(rows, [F.col("o_orderkey")], 3)


@query(
    "SELECT user_id, n, row_num, (row_num - 1 - 5) // 20 AS page FROM (SELECT user_id, n, row_number() OVER "
    "(ORDER BY n DESC, user_id) AS row_num FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)) WHERE row_num > 5"
)
def report_pages(spark, sf):
    report = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return with_pages(report, [F.col("n").desc(), F.col("user_id").asc()], 20, skip=5)


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey > 99 ORDER BY p_partkey LIMIT 20")
def next_page_by_key(spark, sf):
    return after_key(table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", 99, 20)


# ---- scalar functions ---------------------------------------------------------------------------


@query(
    "SELECT p_partkey, upper(trim(p_name)) AS name, lower(p_brand) AS brand, len(string_split(p_name, ' ')) AS n_words, "
    "string_split(p_name, ' ')[1] AS first_word, array_to_string(list_transform(string_split(p_name, ' '), lambda x: trim(x)), '|') "
    "AS joined, concat(p_type, '/', p_brand) AS label, coalesce(nullif(p_type, 'PROMO'), 'none') AS kind, "
    "nullif(len(CASE WHEN p_type = 'SMALL' THEN [] ELSE string_split(p_name, ' ') END), 0) AS n_or_null FROM part"
)
def text_functions(spark, sf):
    words = split_list(F.col("p_name"), " ")
    maybe = split_list(F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_name")), " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.upper(F.trim("p_name")).alias("name"),
        F.lower("p_brand").alias("brand"),
        F.size(words).cast("bigint").alias("n_words"),
        first_element(words).alias("first_word"),
        F.array_join(words, "|").alias("joined"),
        F.concat("p_type", F.lit("/"), "p_brand").alias("label"),
        or_default(F.nullif(F.col("p_type"), F.lit("PROMO")), F.lit("none")).alias("kind"),
        list_length(maybe).cast("bigint").alias("n_or_null"),
    )


@query(
    "SELECT o_orderkey, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, "
    "CAST(extract(YEAR FROM o_orderdate) AS INTEGER) AS y, CAST(extract(MONTH FROM o_orderdate) AS INTEGER) AS m, "
    "o_orderdate - INTERVAL '1 year' AS year_before, o_orderdate + INTERVAL '36 hours' AS later FROM orders"
)
def time_functions(spark, sf):
    at = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        day_of(at).alias("day"),
        month_of(at).alias("month"),
        F.year(at).alias("y"),
        F.month(at).alias("m"),
        (at - F.make_interval(years=F.lit(1))).alias("year_before"),
        (at + F.expr("INTERVAL '36' HOUR")).alias("later"),
    )


@query(
    "SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS whole, CAST(l_quantity AS BIGINT) AS qty, "
    "CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)), 1) AS DECIMAL(18,1)) AS rounded FROM lineitem"
)
def number_functions(spark, sf):
    price = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.floor(price).alias("whole"), F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(price.cast(MONEY), 1).cast("decimal(18,1)").alias("rounded"),
    )


@query("SELECT event_id, event_type FROM events WHERE event_type = 'click' AND user_id >= 10 AND value < 50")
def conjunction(spark, sf):
    conditions = [F.col("event_type") == "click", F.col("user_id") >= 10, F.col("value") < 50]
    return table(spark, sf, "events").filter(all_of(conditions)).select("event_id", "event_type")
