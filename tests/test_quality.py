import pytest
from pyspark.sql import functions as F

from promoledger.operators import dml, quality
from promoledger.operators.quality import BAD
from promoledger.sources.catalog import child_first_order, columns_frame, constraints_frame, create_tables, has_column
from promoledger.sources.literal import literal
from promoledger.sources.schemas import TABLES, Check, Registry
from tests.conftest import AS_OF, rows


def parents(seed):
    return {name: seed[name] for name in seed}


@pytest.mark.parametrize("name", [t for t in TABLES if t in (
    "status_master", "status_transition", "commission_rule", "partner", "promotion_program", "voucher", "customer",
    "partner_click", "customer_voucher", "affiliate_commission", "commission_adjustment", "customer_profiles", "user_region_mapping")])
def test_seed_breaks_no_rule(seed, name):
    flagged = quality.check_table(seed[name], TABLES[name], parents(seed))
    assert quality.split_rows(flagged).rejected.isEmpty()
    assert seed[name].columns == TABLES[name].schema.fieldNames()


def test_seed_sizes(seed):
    sizes = {name: seed[name].count() for name in ("status_master", "t_config_rls", "customer_profiles", "partner", "voucher")}
    assert sizes == {"status_master": 20, "t_config_rls": 14, "customer_profiles": 45, "partner": 5, "voucher": 4}


def customer(spark, ident, phone, **more):
    values = {"customer_id": ident, "first_name": "T", "last_name": "A", "phone_number": phone, "status_id": 1, **more}
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return dml.fill_defaults(df, TABLES["customer"], AS_OF, "X")


def test_repeated_phone_is_rejected_against_batch_and_table(spark, seed):
    batch = customer(spark, 10, "0999888777").unionByName(customer(spark, 11, "0999888777")).unionByName(customer(spark, 12, "0000000001"))
    flagged = quality.check_table(batch, TABLES["customer"], parents(seed), existing=seed["customer"], row_id="customer_id")
    assert rows(quality.violations(flagged, ["customer_id"]), "constraint_name", "customer_id") == [
        ("customer_phone_number_key", 11), ("customer_phone_number_key", 12)]


def test_voucher_over_its_limit_is_rejected(seed):
    change = dml.update_where(seed["voucher"], F.col("voucher_id") == 1, {"total_issued": F.col("issuance_limit") + 10})
    flagged = quality.check_table(change.table, TABLES["voucher"], parents(seed))
    assert rows(quality.violations(flagged, ["voucher_id"]), "constraint_name", "voucher_id") == [("chk_total_issued", 1)]


def test_null_semantics(spark):
    df = literal(spark, [(1, None, None), (2, 5, 9)], "id int, a int, fk int")
    flagged = quality.flag_rows(df, {"chk": F.col("a") > 10})
    flagged = quality.flag_orphans(flagged, "fk", ["fk"], literal(spark, [(1,)], "k int"), ["k"])
    assert rows(flagged, "id", BAD) == [(1, []), (2, ["chk", "fk"])]
    twins = quality.flag_duplicates(quality.flag_rows(literal(spark, [(1, None), (2, None)], "id int, k int"), {}), "uq", ["k"])
    assert quality.split_rows(twins).rejected.isEmpty()


def test_length_and_not_null(spark):
    batch = literal(spark, [(1, "x" * 51, "n"), (2, None, "n")], "partner_id bigint, partner_code string, partner_name string")
    flagged = quality.flag_rows(dml.fill_defaults(batch, TABLES["partner"], AS_OF, "X"), quality.row_rules(TABLES["partner"]))
    assert rows(quality.violations(flagged, ["partner_id"]), "constraint_name", "partner_id") == [
        ("partner_partner_code_length", 1), ("partner_partner_code_not_null", 2)]


def test_decimal_fit(spark):
    df = literal(spark, [("12.5",), ("123456",), ("abc",), (None,)], "v string")
    assert rows(df.select("v", quality.decimal_fits(F.col("v"), 5, 2).alias("ok"))) == [
        ("12.5", True), ("123456", False), ("abc", False), (None, True)]


def test_rule_added_at_run_time(spark):
    registry = Registry()
    ledger = literal(spark, [(1, "spend", "500000"), (2, "spend", "-9999999")], "transaction_id bigint, entry_type string, amount string")
    ledger = ledger.withColumn("program_id", F.lit(1)).select("*")
    filled = dml.fill_defaults(ledger, TABLES["budget_transaction"], AS_OF, "X")
    check = Check("chk_bt_amount_positive", "amount >= 0")
    assert rows(quality.validate_new_check(filled, check), "transaction_id") == [(2,)]
    table = registry.add_check("budget_transaction", check)
    split = quality.split_rows(quality.flag_rows(filled, quality.row_rules(table)))
    assert rows(split.valid, "transaction_id") == [(1,)]
    assert len(registry.drop_check("budget_transaction", check.name).checks) == 2


def test_whole_unit_is_dropped(spark):
    schema = "unit_id int, id int, ok boolean"
    flagged = {
        "customer": quality.flag_rows(literal(spark, [(1, 1, True), (2, 2, True)], schema), {"c": F.col("ok")}),
        "claim": quality.flag_rows(literal(spark, [(1, 1, True), (2, 2, True)], schema), {"c": F.col("ok")}),
        "ledger": quality.flag_rows(literal(spark, [(1, 1, True), (2, 2, False)], schema), {"c": F.col("ok")}),
    }
    split = quality.quarantine_units(flagged, "unit_id")
    assert {n: rows(s.valid, "unit_id") for n, s in split.items()} == {n: [(1,)] for n in flagged}
    assert {n: rows(s.rejected, "unit_id") for n, s in split.items()} == {n: [(2,)] for n in flagged}
    # Accepting row by row instead leaves a partial unit behind.
    landed = None
    for name, df in flagged.items():
        part = quality.split_rows(df).valid.select("unit_id", F.lit(name).alias("step"))
        landed = part if landed is None else landed.unionByName(part)
    assert rows(quality.partial_units(landed, "unit_id", 3)) == [(2, 2, 3)]


def test_step_with_retry_keeps_the_parent(spark):
    attempts = literal(
        spark,
        [(1, "customer", 1, 1, None), (1, "claim", 1, None, 99999999), (1, "claim", 2, None, 1), (1, "claim", 3, None, 1),
         (2, "customer", 1, None, None), (2, "claim", 1, None, 1)],
        "unit int, step string, attempt int, customer_id int, voucher_id int",
    )
    ok = F.when(F.col("step") == "customer", F.col("customer_id").isNotNull()).otherwise(F.col("voucher_id") == 1)
    split = quality.quarantine_steps(attempts, "unit", "step", "attempt", ok, F.col("step") == "customer")
    assert rows(split.valid, "unit", "step", "attempt") == [(1, "claim", 2), (1, "customer", 1)]
    assert split.rejected.count() == 4


def test_delete_is_restricted(seed):
    doomed = seed["promotion_program"].filter("program_id = 1")
    report = quality.delete_blockers(doomed, TABLES["promotion_program"], {"voucher": seed["voucher"], "budget_transaction": seed["budget_transaction"]}, TABLES)
    assert rows(report) == [("fk_voucher_program", 1)]


def test_child_first_order():
    order = child_first_order()
    for table in TABLES.values():
        for fk in table.foreign_keys:
            assert order.index(table.name) < order.index(fk.parent)


def test_transitions(spark, seed):
    changes = literal(spark, [(1, 14, 15), (2, 14, 17), (3, 17, 15)], "id int, from_status_id bigint, to_status_id bigint")
    changes = changes.withColumn("entity_type", F.lit("PROMOTION_PROGRAM"))
    bad = quality.illegal_transitions(changes, seed["status_transition"], seed["status_master"])
    assert rows(bad, "id", "reason") == [(2, "no such transition"), (3, "from final status")]


def test_status_of_another_entity(spark, seed):
    claims = literal(spark, [(1, 1), (2, 6)], "id int, status_id bigint")
    assert rows(quality.wrong_entity_status(claims, seed["status_master"], "CUSTOMER_VOUCHER"), "id") == [(1,)]


def test_catalog(spark, seed):
    assert has_column(seed["partner"], "PARTNER_CODE") and not has_column(seed["partner"], "nope")
    kinds = {r.kind: r["count"] for r in constraints_frame(spark).groupBy("kind").count().collect()}
    assert kinds["f"] == 20 and kinds["u"] == 5 and kinds["c"] == 10
    assert columns_frame(spark, {"t": seed["voucher"]}).count() == len(seed["voucher"].columns)
    create_tables(spark, "promo_test", [TABLES["partner"], TABLES["voucher"]], rebuild=True)
    create_tables(spark, "promo_test", [TABLES["partner"]])
    seed["partner"].write.insertInto("promo_test.partner")
    assert spark.table("promo_test.partner").count() == 5


def test_summary(spark):
    flagged = quality.flag_rows(spark.range(4).withColumnRenamed("id", "k"), {"low": F.col("k") > 1, "odd": F.col("k") % 2 == 1})
    report = quality.constraint_summary(spark, {"t": quality.violations(flagged, ["k"])})
    assert rows(report) == [("low", 2), ("odd", 2)]


def test_bad_rows_without_a_unit_and_repeated_attempts(spark):
    flagged = literal(spark, [(None, 1, []), (None, 2, ["chk"]), (1, 3, []), (2, 4, ["chk"]), (2, 5, [])], f"u int, v int, {quality.BAD} array<string>")
    done = quality.quarantine_units({"t": flagged}, "u")["t"]
    assert sorted(r.v for r in done.valid.collect()) == [1, 3] and sorted(r.v for r in done.rejected.collect()) == [2, 4, 5]
    tries = literal(spark, [(1, 1, 1, "a"), (1, 1, 1, "b"), (1, 2, 1, "c"), (1, 2, 1, "c")], "u int, s int, n int, x string")
    split = quality.quarantine_steps(tries, "u", "s", "n", F.col("x").isNotNull())
    assert split.valid.count() == 2 and split.rejected.count() == 2
