import os

import pytest
from pyspark.sql import functions as F

from promoledger.operators import layout, profile
from promoledger.plans import reports
from promoledger.sources import feeds
from promoledger.sources.literal import literal
from promoledger.sources.synthetic import random_clicks
from tests.conftest import plan, rows

CLICK = "click_id bigint, partner_id bigint, clicked_at timestamp_ntz, is_suspicious boolean, reconciliation_status_id bigint"
HALF_YEAR = layout.MonthRange("clicked_at", (2026, 1), (2026, 6))


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bench") / "clicks")
    random_clicks(spark, 3000).write.parquet(path)
    return spark.read.schema(CLICK).parquet(path)


@pytest.fixture(scope="module")
def by_month(spark, bench, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("month") / "clicks")
    layout.write_partitioned(bench, HALF_YEAR, path, sort=["partner_id", "clicked_at"])
    return path


def stored(spark, path, partition="month string"):
    return spark.read.schema(f"{CLICK}, {partition}").parquet(path)


def test_synthetic_rows_repeat_whatever_the_partitioning(spark):
    clicks = random_clicks(spark, 3000)
    assert clicks.exceptAll(random_clicks(spark, 3000).repartition(7)).isEmpty()
    stats = clicks.agg(
        F.min("partner_id"), F.max("partner_id"), F.avg(F.col("is_suspicious").cast("int")), F.avg(F.col("reconciliation_status_id").isNotNull().cast("int"))
    ).first()
    assert stats[0] == 1 and stats[1] == 5 and 0.07 < stats[2] < 0.13 and 0.26 < stats[3] < 0.34
    assert random_clicks(spark, 100, "2025-12-01", 30, first_id=900001).agg(F.min("click_id"), F.max("click_id")).first() == (900001, 900100)


def test_months_hold_even_shares_and_empty_default_is_absent(spark, by_month):
    counts = {r.partition_name: r.row_count for r in layout.partition_counts(stored(spark, by_month), HALF_YEAR).collect()}
    assert sorted(counts) == HALF_YEAR.months() and sum(counts.values()) == 3000
    assert all(400 < n < 600 for n in counts.values())


def test_month_read_touches_one_folder(spark, by_month, bench):
    part = layout.read_range(stored(spark, by_month), HALF_YEAR, "2026-03-01", "2026-04-01")
    expected = bench.filter("clicked_at >= timestamp_ntz'2026-03-01' AND clicked_at < timestamp_ntz'2026-04-01'")
    assert rows(part, "click_id") == rows(expected, "click_id")
    assert "PartitionFilters: [" in plan(part) and "2026-03" in plan(part)
    folders = {r[0] for r in part.select(F.regexp_extract("_metadata.file_path", "month=([^/]+)", 1)).distinct().collect()}
    assert folders == {"2026-03"}


@pytest.mark.parametrize(
    "start,end,expected",
    [
        ("2026-03-01", "2026-04-01", ["2026-03"]),
        ("2026-03-15", "2026-04-02", ["2026-03", "2026-04"]),
        ("2026-06-15", "2026-07-01", ["2026-06"]),
        ("2026-06-15", "2026-07-02", ["2026-06", layout.DEFAULT]),
        ("2025-12-31", "2026-01-01", [layout.DEFAULT]),
        ("2025-12-31", "2026-01-02", ["2026-01", layout.DEFAULT]),
    ],
)
def test_pruning(start, end, expected):
    assert HALF_YEAR.prune(start, end) == expected


def test_attach_detach_and_later_month(spark, bench, by_month, tmp_path):
    december = random_clicks(spark, 100, "2025-12-01", 30, first_id=900001)
    path = str(tmp_path / "clicks")
    layout.write_partitioned(bench, HALF_YEAR, path)
    with pytest.raises(ValueError):
        layout.attach(bench, HALF_YEAR, 2025, 12, path)
    crowded = str(tmp_path / "crowded")
    layout.write_partitioned(bench.unionByName(december), HALF_YEAR, crowded)
    with pytest.raises(ValueError, match="default partition"):
        layout.attach(december, HALF_YEAR, 2025, 12, crowded)
    wider = layout.attach(december, HALF_YEAR, 2025, 12, path)
    counts = {r.partition_name: r.row_count for r in layout.partition_counts(stored(spark, path), wider).collect()}
    assert counts["2025-12"] == 100 and wider.first == (2025, 12)
    assert layout.expired_months(wider, "2026-07-03", 6) == ["2025-12"]
    assert HALF_YEAR.extended((2026, 7)).months()[-1] == "2026-07"


def test_catalog_partitions(spark, bench, by_month):
    spark.sql("CREATE DATABASE IF NOT EXISTS layout_test")
    spark.sql("DROP TABLE IF EXISTS layout_test.events")
    columns = ", ".join(CLICK.split(", "))
    spark.sql(f"CREATE TABLE layout_test.events ({columns}, month string) USING parquet PARTITIONED BY (month)")
    for month in ("2026-01", "2026-02"):
        layout.attach_location(spark, "layout_test.events", "month", month, f"{by_month}/month={month}")
    before = spark.table("layout_test.events").groupBy("month").count().count()
    layout.detach(spark, "layout_test.events", "month", "2026-01")
    assert before == 2 and rows(spark.table("layout_test.events").select("month").distinct()) == [("2026-02",)]
    profile.analyze(spark, "layout_test.events")
    profile.analyze(spark, "layout_test.events", ["partner_id"])
    assert "rows" in spark.sql("DESCRIBE EXTENDED layout_test.events").filter("col_name = 'Statistics'").first().data_type


def test_list_and_hash_layouts(spark, bench, tmp_path):
    rule = layout.ListPartition("partner_id", (1, 2, 3, 4))
    layout.write_partitioned(bench, rule, str(tmp_path / "list"))
    listed = stored(spark, str(tmp_path / "list"), "partition_of string")
    counts = {r.partition_name: r.row_count for r in layout.partition_counts(listed, rule).collect()}
    assert sorted(counts) == ["1", "2", "3", "4", layout.DEFAULT]
    assert layout.read_listed(listed, rule, 5).count() == counts[layout.DEFAULT] == bench.filter("partner_id = 5").count()
    buckets = layout.HashPartition("click_id", 4)
    layout.write_partitioned(bench, buckets, str(tmp_path / "hash"))
    hashed = stored(spark, str(tmp_path / "hash"), "bucket int")
    sizes = [r.row_count for r in layout.partition_counts(hashed, buckets).collect()]
    assert len(sizes) == 4 and min(sizes) > 650
    found = layout.read_key(hashed, buckets, 1234)
    assert rows(found, "click_id") == [(1234,)] and "PartitionFilters: [isnotnull(bucket" in plan(found)


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        hot = spark.range(200_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(9).alias("partner_id"), F.sha2(F.col("id").cast("string"), 256).alias("x")
        ).repartition(8)
        layout.write_partitioned(hot, layout.ListPartition("partner_id", (0, 1, 2, 3, 4, 9)), str(tmp_path / "hot"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(str(tmp_path / "hot"))
    files = {r.partition_of: r.n for r in back.groupBy("partition_of").agg(F.count_distinct("_metadata.file_path").alias("n")).collect()}
    assert files[9] > 3 and back.count() == 200_000


def test_clustering(spark, bench, tmp_path):
    layout.write_clustered(bench.repartition(4), str(tmp_path / "seq"), "clicked_at")
    tight = layout.file_overlap(spark.read.schema(CLICK).parquet(str(tmp_path / "seq")), "clicked_at")
    assert tight.agg(F.max("overlaps"), F.sum("n_rows")).first() == (1, 3000)
    bench.repartition(4).write.parquet(str(tmp_path / "loose"))
    loose = layout.file_overlap(spark.read.schema(CLICK).parquet(str(tmp_path / "loose")), "clicked_at")
    assert loose.agg(F.min("overlaps")).first()[0] == 4


def test_profiles(bench):
    row = profile.cardinalities(bench, ["partner_id", "is_suspicious", "reconciliation_status_id", "click_id"]).first()
    assert tuple(row) == (5, 2, 1, 3000, 3000)
    approximate = profile.cardinalities(bench, ["click_id"], approximate=True).first()
    assert 2700 < approximate.cardinality_click_id < 3300
    shares = profile.selectivities(bench, {"p3": (F.col("partner_id") == 3, 4), "one": (F.col("click_id") == 1234, 8)}).first()
    assert 0.17 < float(shares.p3) < 0.23 and float(shares.one) == round(1 / 3000, 8)
    nulls = {r.column_name: r for r in profile.column_profile(bench, ["reconciliation_status_id", "partner_id"]).collect()}
    assert float(nulls["partner_id"].null_frac) == 0 and 0.6 < float(nulls["reconciliation_status_id"].null_frac) < 0.8
    assert profile.common_values(bench, ["partner_id"], 3).count() == 3


def test_extract_and_rollup(spark, bench):
    assert layout.unreconciled_extract(bench).filter("is_suspicious OR reconciliation_status_id IS NOT NULL").isEmpty()
    rollup = reports.daily_rollup(bench)
    march = reports.daily_rollup(bench.filter(layout.in_month("clicked_at", 2026, 3)))
    assert rollup.exceptAll(reports.merge_rollup(rollup, march)).isEmpty()
    assert layout.bounds_of(bench, "click_id").first() == (1, 3000)


def test_archive_twice_keeps_one_copy(spark, tmp_path):
    history = literal(spark, [(1, "2026-01-10"), (2, "2026-03-16"), (3, "2026-03-18"), (4, "2026-06-01")], "history_id int, at string")
    history = history.select("history_id", F.col("at").cast("timestamp_ntz").alias("changed_at"))
    path = str(tmp_path / "lake")
    kept = feeds.archive(history, path, "2026-06-15", 90)
    feeds.archive(history, path, "2026-06-15", 90)
    assert rows(kept, "history_id") == [(3,), (4,)]
    # The rest of a month that was archived in part follows later.
    feeds.archive(kept, path, "2026-06-20", 90)
    assert rows(spark.read.parquet(path), "history_id") == [(1,), (2,), (3,)]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_feed_formats(spark, seed, tmp_path, fmt):
    path = str(tmp_path / fmt)
    frame = seed["partner"].select("partner_id", "partner_code", "created_at", "is_deleted")
    writer = frame.write.option("header", "true") if fmt == "csv" else frame.write
    writer.format(fmt).save(path)
    back = feeds.read_feed(spark, path, frame.schema, fmt)
    assert rows(back) == rows(frame)
    with pytest.raises(ValueError):
        feeds.read_feed(spark, path, frame.schema, "avro?")


def test_prune_to_the_second():
    half = layout.MonthRange("clicked_at", (2026, 1), (2026, 6))
    assert half.prune("2026-06-20", "2026-07-01T12:00:00") == ["2026-06", layout.DEFAULT]
    assert half.prune("2026-06-20 10:00:00", "2026-07-01 00:00:00") == ["2026-06"]


def test_month_added_on_disk_moves_default_rows_only(spark, bench, tmp_path, monkeypatch):
    path = str(tmp_path / "clicks")
    short = layout.MonthRange("clicked_at", (2026, 1), (2026, 4))
    layout.write_partitioned(bench, short, path)

    def files():
        found = {}
        for folder in sorted(os.listdir(path)):
            if folder.startswith("month="):
                found[folder] = {(f, os.stat(f"{path}/{folder}/{f}").st_mtime_ns) for f in os.listdir(f"{path}/{folder}")}
        return found

    before, replace = files(), layout.replace_folder

    def lost(df, folder):
        raise OSError("lost")

    # Stopped after the month was written: nothing is lost, and the call may be made again.
    monkeypatch.setattr(layout, "replace_folder", lost)
    with pytest.raises(OSError):
        layout.add_month_stored(spark, short, 2026, 5, path, bench.schema)
    assert bench.select("click_id").exceptAll(stored(spark, path).select("click_id")).isEmpty()
    monkeypatch.setattr(layout, "replace_folder", replace)
    for _ in range(2):
        wider = layout.add_month_stored(spark, short, 2026, 5, path, bench.schema)
        now = stored(spark, path)
        assert rows(now.select("click_id")) == rows(bench.select("click_id"))
        assert now.filter(F.col("month") != wider.value()).isEmpty()
    after = files()
    assert after.keys() - before.keys() == {"month=2026-05"}
    assert all(after[f] == before[f] for f in before if f != "month=__default__")
    assert after["month=__default__"] != before["month=__default__"]


def test_profiles_merge_from_stored_sketches(spark, tmp_path):
    rows_ = spark.range(20_000).selectExpr(
        "concat('2024-0', id % 3 + 1) AS month", "id AS k", "if(id % 4 = 0, null, concat('v', least(id % 100, 3))) AS word",
        "cast(null AS double) AS gone", "if(id % 5 = 0, double('nan'), id / 10) AS x")
    path, columns = str(tmp_path / "sketches"), ["k", "word", "gone", "x"]
    profile.refresh_profiles(rows_, "month", columns, path)
    march = rows_.filter("month = '2024-03'").withColumn("word", F.lit("new"))
    profile.refresh_profiles(march, "month", columns, path)
    got = {r.column_name: r for r in profile.merged_profile(spark.read.parquet(path), 0.25, 2).collect()}
    assert {c: r.n_rows for c, r in got.items()} == dict.fromkeys(columns, 20_000)
    assert abs(got["k"].n_distinct - 20_000) < 1000 and abs(got["k"].quantile - 5000) < 400 and abs(got["x"].quantile - 500) < 40
    assert got["gone"].quantile is None and got["gone"].n_nulls == 20_000 and got["gone"].n_distinct == 0 and got["gone"].common == []
    exact = rows_.filter("month < '2024-03'").unionByName(march).filter("word is not null").groupBy("word").count().orderBy(F.desc("count")).limit(2).collect()
    assert [tuple(v) for v in got["word"].common] == [tuple(v) for v in exact] and got["word"].quantile is None
    text = plan(profile.profile_sketches(rows_, "month", columns), "simple")
    assert "Expand" not in text and text.count("Exchange") == 1
    profile.refresh_profiles(rows_.limit(0), "month", columns, path)
    assert profile.merged_profile(spark.read.parquet(path)).count() == 4


def test_correlation_leaves_rows_in_place(spark, tmp_path):
    spark.range(1000).selectExpr("id AS x").coalesce(1).write.parquet(str(tmp_path / "rows"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = layout.clustering_correlation(spark.read.parquet(str(tmp_path / "rows")), F.col("x"))
        plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert found.first()[0] > 0.999
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
