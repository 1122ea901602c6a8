import random

import pytest
from pyspark.sql import functions as F

from promoledger.operators import counters
from promoledger.sources.literal import literal
from tests.conftest import plan, rows

_LOW = -(2**63)


def claims_of(spark, n, voucher=1):
    return spark.range(n).select(F.col("id").alias("claim_id"), F.lit(voucher).cast("bigint").alias("voucher_id"), (F.col("id") % 7).alias("at"))


def quota(spark, limit, issued):
    return literal(spark, [(1, limit, issued)], "voucher_id bigint, issuance_limit int, total_issued int")


@pytest.mark.parametrize("limit,issued,n,granted", [(1000, 999, 10, 1), (1000, 0, 500, 500), (5, 5, 3, 0)])
@pytest.mark.parametrize("hot_rows", [4, 10_000])
def test_allocation_never_exceeds_the_limit(spark, limit, issued, n, granted, hot_rows):
    done = counters.allocate_capped(claims_of(spark, n), quota(spark, limit, issued), "voucher_id", [F.col("at"), F.col("claim_id")], hot_rows=hot_rows)
    assert done.count() == n
    assert done.filter("granted").count() == granted
    after = counters.advance_counters(quota(spark, limit, issued), done, "voucher_id").first()
    assert after.total_issued == issued + granted <= limit


def test_unknown_voucher_is_refused(spark):
    done = counters.allocate_capped(claims_of(spark, 3, 77), quota(spark, 10, 0), "voucher_id", [F.col("claim_id")])
    assert done.filter("granted").count() == 0 and done.count() == 3


def test_allocation_against_brute_force(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([1, 1, 1, 2, 3]), rng.randrange(20)) for i in range(400)]
    limits = {1: (60, 10), 2: (10, 9), 3: (500, 0)}
    left = {v: a - b for v, (a, b) in limits.items()}
    expected = set()
    for claim, voucher, _ in sorted(data, key=lambda r: (r[2], r[0])):
        if left[voucher] > 0:
            left[voucher] -= 1
            expected.add(claim)
    claims = literal(spark, data, "claim_id bigint, voucher_id bigint, at bigint")
    quotas = literal(spark, [(v, a, b) for v, (a, b) in limits.items()], "voucher_id bigint, issuance_limit int, total_issued int")
    done = counters.allocate_capped(claims, quotas, "voucher_id", [F.col("at"), F.col("claim_id")], hot_rows=50)
    assert {r.claim_id for r in done.filter("granted").collect()} == expected
    # The same by the last claim covered, with cells so small that it takes several rounds and without any.
    for cell_rows in (1, 50, 1024):
        short = counters.grant_claims(claims, quotas, "voucher_id", ["at", "claim_id"], cell_rows=cell_rows)
        assert short.count() == 400 and {r.claim_id for r in short.filter("granted").collect()} == expected


def test_ties_never_exceed_the_quota(spark):
    tied = literal(spark, [(i, 1, 7) for i in range(10)], "claim_id bigint, voucher_id bigint, at bigint")
    same = literal(spark, [(1, 1, 7)] * 10, "claim_id bigint, voucher_id bigint, at bigint")
    schema = "voucher_id bigint, issuance_limit int, total_issued int"
    for claims in (tied, same):
        for more in ([], [(9, 5000, 0)]):
            done = counters.grant_claims(claims, literal(spark, [(1, 3, 0), *more], schema), "voucher_id", ["at"])
            assert done.count() == 10 and done.filter("granted").count() == 3
    with pytest.raises(Exception, match="more than one quota"):
        counters.grant_claims(tied, literal(spark, [(1, 3, 0), (1, 3, 0)], schema), "voucher_id", ["at"]).collect()


def test_small_and_large_quotas_equal_sql(spark):
    import duckdb

    claims = spark.range(12_000).select(
        F.col("id").alias("claim_id"), F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id") % 3).alias("voucher_id"),
        F.expr("timestamp_ntz'2024-03-31 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, pmod(id * 7919, 5003) * 1.000001)").alias("at"),
    )
    quotas = literal(spark, [(1, 3, 0), (2, 5000, 1999), (3, 5000, 0), (4, 7, 0)], "voucher_id bigint, issuance_limit int, total_issued int")
    con = duckdb.connect()
    con.register("claims", claims.toArrow())
    con.register("quotas", quotas.toArrow())
    want = con.sql(
        "SELECT claim_id, coalesce(no <= issuance_limit - total_issued, FALSE) FROM (SELECT *, row_number() OVER "
        "(PARTITION BY voucher_id ORDER BY \"at\", claim_id) AS no FROM claims) LEFT JOIN quotas USING (voucher_id)"
    ).fetchall()
    for cell_rows in (8, 1024):
        done = counters.grant_claims(claims, quotas, "voucher_id", ["at", "claim_id"], cell_rows=cell_rows)
        assert rows(done, "claim_id", "granted") == sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["string", "binary", "decimal(18,4)", "date", "timestamp", "boolean", "double", "smallint"])
def test_order_columns_of_any_type_nulls_first(spark, kind):
    rng = random.Random(11)
    texts = ["", "a", "a\u0000", "ab", "Zürich", "日本語日本語", "aaaaaaaaaaaaab", "aaaaaaaaaaaaac", None]
    value = {
        "string": lambda: rng.choice(texts), "binary": lambda: rng.choice(texts),
        "decimal(18,4)": lambda: rng.choice([None, "-99999999999999.9999", "0.0001", "-0.0001", "12.5"]),
        "date": lambda: rng.choice([None, "0001-01-01", "1969-12-31", "2024-02-29"]),
        "timestamp": lambda: rng.choice([None, "1969-12-31 23:59:59.999999", "2024-02-29 00:00:00"]),
        "boolean": lambda: rng.choice([None, "true", "false"]),
    }.get(kind, lambda: rng.choice([None, "-3", "0", "7"]))
    claims = literal(spark, [(i, rng.choice([1, 1, 2, None]), value()) for i in range(120)], "claim_id bigint, voucher_id bigint, at string")
    claims = claims.withColumn("at", F.col("at").cast(kind))
    quotas = literal(spark, [(1, 31, 0), (2, 13, 0), (3, 1, 0)], "voucher_id bigint, issuance_limit int, total_issued int")
    want = counters.allocate_capped(claims, quotas, "voucher_id", [F.col("at").asc(), F.col("claim_id")])
    got = counters.grant_claims(claims, quotas, "voucher_id", ["at", "claim_id"], cell_rows=2)
    assert rows(got, "claim_id", "granted") == rows(want, "claim_id", "granted")


def test_equal_claims_at_the_cut_and_empty_tables(spark):
    schema = "voucher_id bigint, issuance_limit int, total_issued int"
    same = spark.range(9000).select(F.lit(5).alias("claim_id"), F.lit(1).cast("bigint").alias("voucher_id"), F.lit(_LOW).alias("at"))
    for cell_rows in (4, 100_000):
        done = counters.grant_claims(same, literal(spark, [(1, 4999, 0)], schema), "voucher_id", ["at"], cell_rows=cell_rows)
        assert (done.count(), done.filter("granted").count()) == (9000, 4999)
    nothing = counters.grant_claims(same.limit(0), literal(spark, [(1, 3, 0)], schema), "voucher_id", ["at"])
    assert nothing.isEmpty() and nothing.columns == ["claim_id", "voucher_id", "at", "granted"]
    refused = counters.grant_claims(same.limit(5), literal(spark, [], schema), "voucher_id", ["at"])
    assert rows(refused.groupBy("granted").count()) == [(False, 5)]


def test_claims_stay_in_place_when_only_grants_are_asked(spark, tmp_path):
    claims_of(spark, 1000).write.parquet(str(tmp_path / "claims"))
    stored = spark.read.parquet(str(tmp_path / "claims"))
    text = plan(counters.grant_claims(stored, quota(spark, 10, 0), "voucher_id", ["at", "claim_id"]))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_increments_are_not_lost(spark):
    target = literal(spark, [(1, 60), (2, 10_000_000), (3, 5)], "id int, total bigint")
    deltas = literal(spark, [(1, 10), (1, 10), (2, -1_000_000), (2, -2_000_000)], "id int, d bigint")
    assert rows(counters.apply_increments(target, deltas, "id", "total", "d")) == [(1, 80), (2, 7_000_000), (3, 5)]


def test_lost_update_report(spark):
    target = literal(spark, [(1, 10_000_000)], "id int, total bigint")
    deltas = literal(spark, [(1, -1_000_000, 1), (1, -2_000_000, 2)], "id int, d bigint, seq int")
    assert rows(counters.lost_updates(target, deltas, "id", "total", "d", "seq")) == [(1, 7_000_000, 8_000_000, -1_000_000)]


def test_first_commit_wins(spark):
    writes = literal(spark, [(1, 7, 1, 5), (1, 7, 2, 6), (1, 8, 3, 7), (None, 7, 4, 8), (None, 7, 5, 9)], "id int, base int, seq int, v int")
    done = counters.first_commit_wins(writes, ["id"], "base", "seq")
    assert rows(done, "seq", "outcome") == [(1, "applied"), (2, "conflict"), (3, "applied"), (4, "applied"), (5, "conflict")]
    assert rows(counters.last_write_wins(writes, ["id"], "v", "seq")) == [(1, 7), (None, 9)]
