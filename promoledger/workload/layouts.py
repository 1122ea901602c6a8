"""Partition layouts, pruned reads, clustering and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.functions.predicates import half_open
from promoledger.operators import layout, profile
from promoledger.plans import reports
from promoledger.session import scratch_path
from promoledger.workload.views import SCHEMAS, ratio_sql, sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


_MONTHS = layout.MonthRange("l_shipdate", (1996, 1), (1998, 12))
_MONTH_SQL = (
    "CASE WHEN l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '{end}' THEN strftime(l_shipdate, '%Y-%m') ELSE '__default__' END"
)


def _stored(spark, sf, rule, name="lineitem", sort=()):
    """Write a table under a partition rule and read it back with its partition column."""
    path = scratch_path(spark, "layout")
    layout.write_partitioned(table(spark, sf, name), rule, path, sort=sort)
    kind = "int" if isinstance(rule, layout.HashPartition) else "string"
    return spark.read.schema(f"{SCHEMAS[name]}, {rule.partition} {kind}").parquet(path), path


@query(f"SELECT {_MONTH_SQL.format(end='1999-01-01')} AS partition_name, count(*) AS row_count FROM lineitem GROUP BY 1")
def month_partition_counts(spark, sf):
    return layout.partition_counts(_stored(spark, sf, _MONTHS)[0], _MONTHS)


@query(
    "SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-05-01'"
)
def month_partition_read(spark, sf):
    stored, _ = _stored(spark, sf, _MONTHS)
    return layout.read_range(stored, _MONTHS, "1997-03-01", "1997-05-01").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-11-15' AND l_shipdate < TIMESTAMP '1999-02-01'")
def month_partition_read_default(spark, sf):
    stored, _ = _stored(spark, sf, _MONTHS)
    return layout.read_range(stored, _MONTHS, "1998-11-15", "1999-02-01").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")


@query("SELECT count(*) AS n FROM lineitem WHERE l_suppkey = 3")
def read_without_partition_key(spark, sf):
    stored, _ = _stored(spark, sf, _MONTHS)
    return stored.filter(F.col("l_suppkey") == 3).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {_MONTH_SQL.format(end='1999-02-01')} AS partition_name, count(*) AS row_count FROM lineitem GROUP BY 1")
def month_partition_added(spark, sf):
    stored, _ = _stored(spark, sf, _MONTHS)
    moved, wider = layout.add_month(stored, _MONTHS, 1999, 1)
    return layout.partition_counts(moved, wider)


@query(f"SELECT l_orderkey, l_linenumber, l_shipdate, {_MONTH_SQL.format(end='1998-12-01')} AS month FROM lineitem")
def month_partition_added_stored(spark, sf):
    """Months are declared to October on disk, then November is added to the stored table."""
    lines = table(spark, sf, "lineitem")
    path, known = scratch_path(spark, "layout"), layout.MonthRange("l_shipdate", (1996, 1), (1998, 10))
    layout.write_partitioned(lines, known, path)
    layout.add_month_stored(spark, known, 1998, 11, path, lines.schema)
    stored = spark.read.schema(f"{SCHEMAS['lineitem']}, month string").parquet(path)
    return stored.select("l_orderkey", "l_linenumber", "l_shipdate", "month")


@query(
    "SELECT CASE WHEN l_shipdate >= TIMESTAMP '1995-12-01' AND l_shipdate < TIMESTAMP '1999-01-01' THEN strftime(l_shipdate, '%Y-%m') ELSE '__default__' END "
    "AS partition_name, count(*) AS row_count FROM lineitem GROUP BY 1"
)
def month_partition_attached(spark, sf):
    lines = table(spark, sf, "lineitem")
    path = scratch_path(spark, "layout")
    december = F.coalesce(half_open("l_shipdate", "1995-12-01", "1996-01-01"), F.lit(False))
    layout.write_partitioned(lines.filter(~december), _MONTHS, path)
    wider = layout.attach(lines.filter(half_open("l_shipdate", "1995-12-01", "1996-01-01")), _MONTHS, 1995, 12, path)
    stored = spark.read.schema(f"{SCHEMAS['lineitem']}, month string").parquet(path)
    return layout.partition_counts(stored, wider)


_BRANDS = layout.ListPartition("p_brand", ("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"))


@query(
    "SELECT CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') THEN p_brand ELSE '__default__' END AS partition_name, "
    "count(*) AS row_count FROM part GROUP BY 1"
)
def list_partition_counts(spark, sf):
    return layout.partition_counts(_stored(spark, sf, _BRANDS, "part")[0], _BRANDS)


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#3', 'Brand#20')")
def list_partition_read(spark, sf):
    stored, _ = _stored(spark, sf, _BRANDS, "part")
    parts = [layout.read_listed(stored, _BRANDS, b).select("p_partkey", "p_brand") for b in ("Brand#3", "Brand#20")]
    return parts[0].unionByName(parts[1])


_BUCKETS = layout.HashPartition("event_id", 4)


@query("SELECT 4::BIGINT AS n_buckets, count(*)::BIGINT AS n_rows, TRUE AS is_even FROM events")
def hash_partition_evenness(spark, sf):
    counts = layout.partition_counts(_stored(spark, sf, _BUCKETS, "events")[0], _BUCKETS)
    even = F.max("row_count") < F.min("row_count") * 1.3
    return counts.agg(F.count(F.lit(1)).alias("n_buckets"), F.sum("row_count").alias("n_rows"), even.alias("is_even"))


@query("SELECT event_id, ts, event_type FROM events WHERE event_id = 777")
def hash_partition_lookup(spark, sf):
    stored, _ = _stored(spark, sf, _BUCKETS, "events")
    return layout.read_key(stored, _BUCKETS, 777).select("event_id", "ts", "event_type")


# ---- clustering ---------------------------------------------------------------------------------


@query("SELECT count(*) AS n_rows, TRUE AS ranges_disjoint FROM lineitem")
def clustered_copy(spark, sf):
    path = scratch_path(spark, "clustered")
    layout.write_clustered(table(spark, sf, "lineitem"), path, "l_shipdate", "l_orderkey")
    overlap = layout.file_overlap(spark.read.schema(SCHEMAS["lineitem"]).parquet(path), "l_shipdate")
    # A day may straddle two neighbouring files; anything more would mean overlapping ranges.
    return overlap.agg(F.sum("n_rows").alias("n_rows"), (F.max("overlaps") <= 3).alias("ranges_disjoint"))


@query("SELECT TRUE AS loose_before, TRUE AS tight_after")
def clustering_quality(spark, sf):
    lines = table(spark, sf, "lineitem")
    path = scratch_path(spark, "clustered")
    layout.write_clustered(lines.select("l_shipdate", "l_orderkey"), path, "l_shipdate")
    after = spark.read.schema("l_shipdate timestamp_ntz, l_orderkey bigint").parquet(path)
    day = F.datediff(F.col("l_shipdate"), F.lit("1970-01-01").cast("date"))
    tight = layout.clustering_correlation(after, day).scalar()
    loose = layout.clustering_correlation(lines, day)
    return loose.select((F.abs("correlation") < 0.5).alias("loose_before"), (tight > 0.9).alias("tight_after"))


# ---- profiles -----------------------------------------------------------------------------------

_COLUMNS = ("partner_id", "is_suspicious", "reconciliation_status_id", "event_type")


def _profile_sql(column: str) -> str:
    nulls = ratio_sql(f"count(*) FILTER (WHERE {column} IS NULL)", "count(*)", 6)
    return (
        f"SELECT '{column}' AS column_name, {nulls} AS null_frac, count(DISTINCT {column}) AS n_distinct, count(*) AS n_rows FROM clicks"
    )


@query(sql(" UNION ALL ".join(_profile_sql(c) for c in _COLUMNS), "clicks"))
def column_profile(spark, sf):
    return profile.column_profile(view(spark, sf, "clicks"), list(_COLUMNS))


@query(
    sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, TRUE AS distinct_within, "
            f"{'TRUE' if c in ('partner_id', 'click_id', 'amount') else 'CAST(NULL AS BOOLEAN)'} AS median_within FROM clicks"
            for c in ("partner_id", "event_type", "click_id", "amount")
        ),
        "clicks",
    )
)
def profile_from_sketches(spark, sf):
    """Profile merged from stored monthly sketches; distinct counts within 5 %, medians within 2 % of the ranks."""
    clicks = view(spark, sf, "clicks").withColumn("month", F.date_format(F.col("clicked_at").cast("date"), "yyyy-MM"))
    columns, path = ["partner_id", "event_type", "click_id", "amount"], scratch_path(spark, "sketches")
    profile.refresh_profiles(clicks, "month", columns, path)
    # A month delivered again replaces its sketches.
    profile.refresh_profiles(clicks.filter("month = '2024-01'"), "month", columns, path)
    merged = profile.merged_profile(spark.read.parquet(path))
    exact = profile.column_profile(clicks, columns).select("column_name", F.col("n_distinct").alias("__exact"))
    shares = []
    for c in ("partner_id", "click_id", "amount"):
        median = merged.filter(F.col("column_name") == c).select("quantile").scalar()
        value = F.col(c).cast("double")
        within = (F.avg((value < median).cast("int")) <= 0.52) & (F.avg((value <= median).cast("int")) >= 0.48)
        shares.append(F.struct(F.lit(c).alias("column_name"), within.alias("median_within")))
    close = clicks.agg(F.array(*shares).alias("__s")).select(F.inline("__s"))
    distinct = F.abs(F.col("n_distinct") - F.col("__exact")) <= 0.05 * F.col("__exact")
    return merged.join(exact, "column_name").join(close, "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", distinct.alias("distinct_within"), "median_within"
    )


def _common_sql(column: str) -> str:
    share = ratio_sql("n", "(SELECT count(*) FROM clicks)", 6)
    return (
        f"SELECT * FROM (SELECT '{column}' AS column_name, value, n, {share} AS frequency FROM (SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n "
        f"FROM clicks WHERE {column} IS NOT NULL GROUP BY 1) ORDER BY n DESC, value LIMIT 5)"
    )


@query(sql(" UNION ALL ".join(_common_sql(c) for c in _COLUMNS), "clicks"))
def common_values(spark, sf):
    return profile.common_values(view(spark, sf, "clicks"), list(_COLUMNS), 5)


@query(
    sql("SELECT click_id, partner_id, clicked_at FROM clicks WHERE NOT is_suspicious AND reconciliation_status_id IS NULL", "clicks")
)
def unreconciled_extract(spark, sf):
    rule = layout.MonthRange("clicked_at", (2024, 1), (2024, 1))
    rows = layout.unreconciled_extract(view(spark, sf, "clicks")).select("click_id", "partner_id", "clicked_at")
    path = scratch_path(spark, "extract")
    layout.write_partitioned(rows, rule, path, sort=["partner_id", "clicked_at"])
    return spark.read.schema(rows.schema.add("month", "string")).parquet(path).drop("month")


@query(sql("SELECT click_id, clicked_at, is_suspicious FROM clicks WHERE partner_id = 3 AND clicked_at >= TIMESTAMP '2024-01-08' AND clicked_at < TIMESTAMP '2024-01-22'", "clicks"))
def partner_month_extract(spark, sf):
    rule = layout.MonthRange("clicked_at", (2024, 1), (2024, 1))
    path = scratch_path(spark, "extract")
    rows = view(spark, sf, "clicks").select("click_id", "partner_id", "clicked_at", "is_suspicious")
    layout.write_partitioned(rows, rule, path, sort=["partner_id", "clicked_at"])
    stored = spark.read.schema(rows.schema.add("month", "string")).parquet(path)
    part = layout.read_range(stored, rule, "2024-01-08", "2024-01-22")
    return reports.click_slice(part, 3, "2024-01-08", "2024-01-22").select("click_id", "clicked_at", "is_suspicious")
