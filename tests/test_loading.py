import pytest
from pyspark.sql import functions as F

from promoledger.operators.dml import chain_keys, next_ids
from promoledger.plans.loading import load_checked
from promoledger.plans.sql_functions import register_profile_reader, register_reports
from promoledger.session import release_scratch, scratch_path, scratch_root
from promoledger.sources.literal import literal
from promoledger.sources.schemas import TABLES, Check, Registry
from promoledger.sources.snapshots import SnapshotStore
from tests.conftest import AS_OF, rows


@pytest.fixture
def store(spark, seed, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.commit({n: df for n, df in seed.items() if n != "t_config_rls"})
    return store


def signups(spark, store):
    """Unit 1 is fine, unit 2 spends a negative amount, unit 3 claims a voucher that does not exist."""
    people = literal(spark, [(1, "0911000001", "A"), (2, "0911000002", "B"), (3, "0911000003", "C")], "unit_id int, phone_number string, last_name string")
    people = people.select("*", F.lit("Test").alias("first_name"), F.lit(1).cast("bigint").alias("status_id"))
    people = next_ids(people, store.read("customer"), "customer_id", [F.col("phone_number")])
    claims = literal(spark, [(1, "0911000001", 1), (2, "0911000002", 1), (3, "0911000003", 99999999)], "unit_id int, phone_number string, voucher_id bigint")
    claims = chain_keys(claims, people, ["phone_number"], "customer_id").drop("phone_number").withColumn("status_id", F.lit(6).cast("bigint"))
    claims = next_ids(claims, store.read("customer_voucher"), "customer_voucher_id", [F.col("customer_id")])
    spend = literal(spark, [(1, 1, "500000", 1), (2, 1, "-9999999", 2), (3, 1, "500000", 3)], "unit_id int, program_id bigint, amount string, transaction_id bigint")
    return {"customer": people, "customer_voucher": claims, "budget_transaction": spend.withColumn("entry_type", F.lit("spend"))}


def with_positive_amounts():
    registry = Registry()
    registry.add_check("budget_transaction", Check("chk_bt_amount_positive", "amount >= 0"))
    return registry.tables


def test_units_land_completely_or_not_at_all(spark, store):
    done = load_checked(store, signups(spark, store), AS_OF, "APP", tables=with_positive_amounts())
    assert rows(store.read("customer").filter("first_name = 'Test'"), "customer_id", "last_name") == [(6, "A")]
    assert rows(store.read("customer_voucher").filter("customer_id > 5"), "customer_voucher_id", "customer_id") == [(6, 6)]
    assert store.read("budget_transaction").count() == 1
    assert rows(done.violations["budget_transaction"], "constraint_name", "unit_id") == [("chk_bt_amount_positive", 2)]
    assert rows(done.violations["customer_voucher"], "constraint_name", "unit_id") == [("fk_cv_voucher", 3)]
    assert rows(done.rejected["customer"], "unit_id") == [(2,), (3,)]


def test_rows_land_one_by_one(spark, store):
    load_checked(store, signups(spark, store), AS_OF, "APP", mode="row", tables=with_positive_amounts())
    assert store.read("customer").filter("first_name = 'Test'").count() == 3
    assert store.read("customer_voucher").filter("customer_id > 5").count() == 2
    assert rows(store.read("budget_transaction"), "transaction_id") == [(1,), (3,)]


def test_parents_of_other_units_do_not_count(spark, store):
    batches = signups(spark, store)
    foreign = batches["customer_voucher"].withColumn("customer_id", F.when(F.col("unit_id") == 1, 7).otherwise(F.col("customer_id")).cast("bigint"))
    done = load_checked(store, {**batches, "customer_voucher": foreign}, AS_OF, "APP")
    assert ("fk_cv_customer", 1) in rows(done.violations["customer_voucher"], "constraint_name", "unit_id")


def test_rejected_parent_takes_its_children_along_in_row_mode(spark, store):
    batches = signups(spark, store)
    taken = batches["customer"].withColumn("phone_number", F.when(F.col("unit_id") == 1, "0000000001").otherwise(F.col("phone_number")))
    done = load_checked(store, {**batches, "customer": taken}, AS_OF, "APP", mode="row")
    assert ("fk_cv_customer", 1) in rows(done.violations["customer_voucher"], "constraint_name", "unit_id")
    with pytest.raises(ValueError):
        load_checked(store, batches, AS_OF, "APP", mode="other")


def test_sql_over_pinned_views(spark, store):
    store.pin().register_views()
    register_reports(spark)
    register_profile_reader(spark)
    assert spark.sql("SELECT * FROM partner_performance_report(timestamp_ntz'2026-06-01', timestamp_ntz'2026-06-30')").count() == 5
    assert spark.sql("SELECT * FROM partner_performance_report(timestamp_ntz'2026-06-01', timestamp_ntz'2026-06-30', array(1L, 2L))").count() == 2
    empty = "CAST(array() AS ARRAY<BIGINT>)"
    assert spark.sql(f"SELECT * FROM partner_performance_report(timestamp_ntz'2026-06-01', timestamp_ntz'2026-06-30', {empty})").isEmpty()
    assert spark.sql("SELECT * FROM program_budget_usage()").count() == 3
    assert spark.sql("SELECT * FROM program_budget_usage(program_ids => array(1L, 2L))").count() == 2
    assert spark.sql("SELECT * FROM program_budget_usage(2L)").isEmpty()
    assert spark.sql("SELECT * FROM customer_profiles_of_region('da_north', 'SOUTH')").isEmpty()
    assert spark.sql("SELECT * FROM customer_profiles_of_region('da_north', 'NORTH')").count() == 15


def test_every_table_of_the_registry_can_be_named(seed):
    assert set(seed) <= set(TABLES)


def test_scratch_is_below_the_configured_folder(spark, tmp_path):
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    release_scratch(spark)
    import os

    assert path.startswith(scratch_root(spark)) and not os.path.exists(path)
