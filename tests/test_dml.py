import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from promoledger.operators import dml
from promoledger.operators.relational import lookup, missing_parents
from promoledger.sources.literal import literal
from promoledger.sources.schemas import TABLES
from tests.conftest import AS_OF, plan, rows

CLICK = "click_id string, partner_id bigint, partner_code string, ip_address string, clicked_at string"


def click(spark, *ids):
    batch = literal(spark, [(i, 2, "P002", "192.0.2.5", AS_OF) for i in ids], CLICK)
    return dml.fill_defaults(batch, TABLES["partner_click"], AS_OF, "ETL_USER")


def test_rerun_of_ignored_insert_adds_nothing(spark, seed):
    once = dml.insert_ignore(seed["partner_click"], click(spark, "RETRY_TEST_002"), ["click_id"])
    twice = dml.insert_ignore(once.table, click(spark, "RETRY_TEST_002"), ["click_id"])
    assert (once.changed.count(), twice.changed.count()) == (1, 0)
    assert once.table.exceptAll(twice.table).isEmpty() and twice.table.count() == 6


def test_ignored_insert_keeps_the_first_copy_of_a_batch_and_all_null_keys(spark):
    target = literal(spark, [(1, "a"), (None, "n")], "k int, v string")
    batch = literal(spark, [(1, "x"), (2, "late"), (2, "early"), (None, "m"), (None, "o")], "k int, v string")
    got = dml.insert_ignore(target, batch, ["k"], [F.col("v")])
    assert rows(got.changed) == [(2, "early"), (None, "m"), (None, "o")]


def test_strict_insert_raises_on_known_and_repeated_keys(spark, seed):
    with pytest.raises(dml.DuplicateKeyError):
        dml.insert_strict(seed["partner_click"], click(spark, "CLICK001"), ["click_id"])
    with pytest.raises(dml.DuplicateKeyError):
        dml.insert_strict(seed["partner_click"], click(spark, "NEW", "NEW"), ["click_id"])
    assert dml.insert_strict(seed["partner_click"], click(spark, "NEW"), ["click_id"]).table.count() == 6


def partner(spark, name, rule, at):
    batch = literal(spark, [(9999, "PARTNER_UPSERT_TEST", name, rule)], "partner_id bigint, partner_code string, partner_name string, commission_rule_id bigint")
    return dml.fill_defaults(batch, TABLES["partner"], at, "ETL_USER")


def test_upsert_updates_listed_columns_and_keeps_the_rest(spark, seed):
    stamp = {"updated_at": F.lit("2026-06-16 00:00:00").cast("timestamp_ntz"), "updated_by": "ETL_USER"}
    columns = ["partner_name", "commission_rule_id"]
    first = dml.upsert(seed["partner"], partner(spark, "A", 1, AS_OF), ["partner_code"], columns, stamp=stamp)
    second = dml.upsert(first.table, partner(spark, "B", 2, "2026-07-01 00:00:00"), ["partner_code"], columns, stamp=stamp)
    got = second.table.filter("partner_code = 'PARTNER_UPSERT_TEST'").collect()
    assert len(got) == 1 and second.table.count() == 6
    assert (got[0].partner_name, got[0].commission_rule_id, str(got[0].created_at)) == ("B", 2, AS_OF)
    assert got[0].updated_by == "ETL_USER"
    assert first.table.filter("partner_code = 'PARTNER_UPSERT_TEST'").first().updated_by is None
    third = dml.upsert(second.table, partner(spark, "B", 2, AS_OF), ["partner_code"], columns, stamp=stamp)
    assert third.table.exceptAll(second.table).isEmpty()


def test_upsert_with_fixed_value(spark, seed):
    batch = literal(spark, [(5, 1, 1, 6), (6, 1, 1, 6)], "customer_voucher_id bigint, customer_id bigint, voucher_id bigint, status_id bigint")
    filled = dml.fill_defaults(batch, TABLES["customer_voucher"], AS_OF, "X")
    got = dml.upsert(seed["customer_voucher"], filled, ["customer_voucher_id"], {"status_id": 6}).table
    assert rows(got.filter("customer_voucher_id >= 5"), "customer_voucher_id", "customer_id", "status_id") == [(5, 5, 6), (6, 1, 6)]


def test_upsert_without_order_fails_on_copies(spark, seed):
    batch = partner(spark, "A", 1, AS_OF).unionByName(partner(spark, "B", 1, AS_OF))
    with pytest.raises(PySparkException, match="more than one incoming row"):
        dml.upsert(seed["partner"], batch, ["partner_code"], ["partner_name"]).table.collect()


def test_update_stamps_matching_rows_even_if_unchanged(seed):
    change = dml.update_where(
        seed["promotion_program"], F.col("program_id") == 1, {"status_id": F.col("status_id")},
        {"updated_at": F.lit(AS_OF).cast("timestamp_ntz")},
    )
    assert rows(change.table.filter("updated_at IS NOT NULL"), "program_id") == [(1,)]
    assert change.table.schema == seed["promotion_program"].schema


def test_guarded_update_changes_only_the_expected_status(seed):
    guard = (F.col("program_id") == 1) & (F.col("status_id") == 15)
    first = dml.update_where(seed["promotion_program"], guard, {"status_id": 16})
    second = dml.update_where(first.table, guard, {"status_id": 16})
    assert rows(first.changed, "program_id", "status_id") == [(1, 16)]
    assert second.changed.isEmpty()


def test_null_condition_neither_updates_nor_deletes(spark):
    df = literal(spark, [(1, None), (2, 5)], "id int, v int")
    assert rows(dml.delete_where(df, F.col("v") > 1).table) == [(1, None)]
    assert rows(dml.update_where(df, F.col("v") > 1, {"v": 0}).table) == [(1, None), (2, 0)]


def test_update_from_fails_on_two_source_rows(spark, seed):
    source = literal(spark, [(1, 1), (1, 2)], "partner_id bigint, r bigint")
    with pytest.raises(PySparkException, match="more than one source row"):
        dml.update_from(seed["partner"], source, ["partner_id"], {"commission_rule_id": "r"}).table.collect()
    unmatched = literal(spark, [(77, 1), (77, 2), (1, 4)], "partner_id bigint, r bigint")
    changed = dml.update_from(seed["partner"], unmatched, ["partner_id"], {"commission_rule_id": "r"}).changed
    assert rows(changed, "partner_id", "commission_rule_id") == [(1, 4)]


def test_null_keys_never_meet_in_an_upsert(spark):
    target = literal(spark, [(1, "a"), (None, "n")], "k int, v string")
    batch = literal(spark, [(1, "b"), (None, "x"), (None, "y")], "k int, v string")
    assert rows(dml.upsert(target, batch, ["k"], ["v"]).table) == [(1, "b"), (None, "n"), (None, "x"), (None, "y")]


def test_ids_continue_from_the_maximum_and_chain_to_children(spark, seed):
    batch = literal(spark, [("0911000002", "B"), ("0911000001", "A")], "phone_number string, last_name string")
    parents = dml.next_ids(batch, seed["customer"], "customer_id", [F.col("phone_number")])
    assert rows(parents, "customer_id", "phone_number") == [(6, "0911000001"), (7, "0911000002")]
    children = literal(spark, [("0911000001", 1)], "phone_number string, voucher_id bigint")
    assert rows(dml.chain_keys(children, parents, ["phone_number"], "customer_id"), "customer_id", "voucher_id") == [(6, 1)]
    empty = seed["customer"].limit(0)
    assert rows(dml.next_ids(batch, empty, "customer_id", [F.col("phone_number")]), "customer_id") == [(1,), (2,)]


def test_defaults_fill_absent_columns_only(spark):
    batch = literal(spark, [("x", None)], "partner_code string, is_deleted boolean")
    row = dml.fill_defaults(batch, TABLES["partner"], AS_OF, "ME").first()
    assert row.is_deleted is None and row.created_by == "ME" and str(row.created_at) == AS_OF and row.updated_at is None
    with pytest.raises(ValueError):
        dml.fill_defaults(batch.withColumn("no_such", F.lit(1)), TABLES["partner"], AS_OF, "ME")


def test_scalar_lookup(spark, seed):
    df = literal(spark, [("SAVED", "CUSTOMER_VOUCHER"), ("NONE", "CUSTOMER_VOUCHER")], "c string, e string")
    on, take = {"c": "status_code", "e": "entity_type"}, {"status_id": "status_id"}
    assert rows(lookup(df, seed["status_master"], on, take), "c", "status_id") == [("NONE", None), ("SAVED", 6)]
    # Codes that several entities share only fail the rows that ask for them.
    single = literal(spark, [("SAVED",)], "c string")
    assert rows(lookup(single, seed["status_master"], {"c": "status_code"}, take)) == [("SAVED", 6)]
    ambiguous = literal(spark, [("ACTIVE",)], "c string")
    with pytest.raises(PySparkException, match="more than one lookup row"):
        lookup(ambiguous, seed["status_master"], {"c": "status_code"}, take).collect()


def test_missing_parents_pass_null_keys(spark, seed):
    child = literal(spark, [(1, 1), (2, 99999999), (3, None)], "id int, voucher_id bigint")
    assert rows(missing_parents(child, ["voucher_id"], seed["voucher"], ["voucher_id"]), "id") == [(2,)]


def test_retention(spark):
    df = literal(spark, [(1, "2025-06-14"), (2, "2025-06-15"), (3, None)], "id int, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    change = dml.retain_since(df, "at", AS_OF, years=1)
    assert rows(change.table, "id") == [(2,), (3,)] and rows(change.changed, "id") == [(1,)]


def test_small_feed_never_shuffles_the_event_log(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.range(100_000).select(F.col("id").cast("string").alias("click_id"), F.repeat(F.lit("x"), 500).alias("payload")).write.parquet(path)
    log = spark.read.parquet(path)
    feed = literal(spark, [("5", "y"), ("new", "y")], "click_id string, payload string")
    fresh = dml.insert_ignore(log, feed, ["click_id"]).changed
    text = plan(fresh)
    assert rows(fresh, "click_id") == [("new",)]
    assert "SortMergeJoin" not in text and "ReadSchema: struct<click_id:string>" in text
