import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from promoledger.operators.numbering import first_per_key, number_rows, rank_within, split_hot, top_per_key, with_previous
from promoledger.operators.relational import after_key, with_pages, write_pages
from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    # A third of all rows under key 0, some under NULL, the rest spread over 40 keys.
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40)
    return spark.range(6000).select("id", key.cast("int").alias("k"), (F.xxhash64("id") % 50).alias("at"))




def order():
    return [F.col("at").asc(), F.col("id").asc()]


def test_number_rows_is_dense_and_ordered(skewed):
    expected = rows(skewed.withColumn("row_num", F.row_number().over(Window.orderBy("at", "id")).cast("bigint")), "id", "row_num")
    assert rows(number_rows(skewed, order()), "id", "row_num") == expected


def test_number_rows_starts_after(skewed):
    got = number_rows(skewed, order(), "n", 100)
    assert got.agg(F.min("n"), F.max("n")).first() == (101, 6100)


@pytest.mark.parametrize("hot_rows", [50, 300, 1_000_000])
def test_rank_equals_plain_window(skewed, hot_rows):
    window = Window.partitionBy("k").orderBy("at", "id")
    expected = rows(skewed.withColumn("row_num", F.row_number().over(window).cast("bigint")), "id", "row_num")
    assert rows(rank_within(skewed, ["k"], order(), hot_rows=hot_rows), "id", "row_num") == expected


@pytest.mark.parametrize("hot_rows", [50, 300, 1_000_000])
def test_previous_equals_plain_lag(skewed, hot_rows):
    window = Window.partitionBy("k").orderBy("at", "id")
    expected = rows(skewed.select("id", F.lag("at").over(window).alias("p"), (F.row_number().over(window) == 1).alias("is_first")))
    got = with_previous(skewed, ["k"], order(), {"p": "at"}, hot_rows)
    assert rows(got, "id", "p", "is_first") == expected


def test_hot_split_covers_all_rows(skewed):
    cold, hot = split_hot(skewed, ["k"], 1000)
    assert {r.k for r in hot.rows.select("k").distinct().collect()} == {0}
    assert cold.count() + hot.rows.count() == skewed.count()


def test_hot_rows_spread_over_tasks(skewed):
    _, hot = split_hot(skewed, ["k"], 300)
    ranged = hot.rows.repartitionByRange(hot.partitions, F.col("k").asc_nulls_first(), *order())
    sizes = [r["count"] for r in ranged.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    total = hot.rows.count()
    assert hot.partitions == -(-total // 300) and max(sizes) < 700 and sum(sizes) == total


def test_first_and_top_per_key_cut_groups_before_the_shuffle(skewed):
    window = Window.partitionBy("k").orderBy("at", "id")
    ranked = skewed.withColumn("rn", F.row_number().over(window))
    assert rows(first_per_key(skewed, ["k"], order()), "id") == rows(ranked.filter("rn = 1"), "id")
    top = top_per_key(skewed, ["k"], order(), 7)
    assert rows(top, "id") == rows(ranked.filter("rn <= 7"), "id")
    assert "WindowGroupLimit" in plan(top)
    assert rows(top_per_key(skewed, ["k"], order(), 1500), "id") == rows(ranked.filter("rn <= 1500"), "id")


def test_pages(spark, skewed, tmp_path):
    paged = with_pages(skewed, order(), 1000, skip=10)
    counts = {r.page: r["count"] for r in paged.groupBy("page").count().collect()}
    assert counts == {0: 1000, 1: 1000, 2: 1000, 3: 1000, 4: 1000, 5: 990}
    write_pages(skewed, order(), 2500, str(tmp_path / "pages"))
    back = spark.read.parquet(str(tmp_path / "pages"))
    assert {r.page: r["count"] for r in back.groupBy("page").count().collect()} == {0: 2500, 1: 2500, 2: 1000}


def test_keyset_paging_walks_all_rows(skewed):
    seen, last = [], None
    while True:
        page = [r.id for r in after_key(skewed.select("id"), "id", last, 2500).collect()]
        if not page:
            break
        seen += page
        last = page[-1]
    assert seen == list(range(6000))
