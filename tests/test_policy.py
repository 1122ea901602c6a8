import random
import re

import pytest
from pyspark.sql import functions as F

from promoledger.operators import policy
from promoledger.sources.literal import literal
from tests.conftest import rows

# What the example configuration must give for each (user, table).
GOLDEN = [
    ("U31", "AnyTable", "1=1"),
    ("U05", "PurchaseOrder", "1=1"),
    ("U05", "Invoice", "1=0"),
    ("U09", "Customer", "1=1"),
    ("UE1", "SaleOrder", "CustomerID LIKE '%123'"),
    ("UE1", "SaleOrderDetail", "ProductID IN ('143','F35')"),
    (
        "U03",
        "PurchaseOrder",
        "(DeliveryMethodName LIKE '%sea%' OR DeliveryMethodName LIKE 'air%') AND PlantID IN ('W1','W4') AND VendorId IN ('VS04','UK8A')",
    ),
    ("U03", "ProductCategory", "CategoryName = 'OLED'"),
    ("U15", "Invoice", "CustomerCategoryName LIKE '%boxes'"),
    ("XXX", "AnyTable", "1=0"),
    ("U09", "Invoice", "1=0"),
    ("ADV", "DeliveryMethod", "(DeliveryMethodName LIKE 'Road%' OR DeliveryMethodName LIKE '%Rail')"),
    ("ADV", "Vendor", "VendorId IN ('VP19','UB55')"),
    ("ADV", "Product", "1=0"),
]
KNOWN = [
    ("Product", "ProductID"), ("Product", "ProductName"), ("Product", "Price"),
    ("Vendor", "VendorID"), ("Vendor", "VendorName"), ("Vendor", "Address"),
    ("DeliveryMethod", "DeliveryMethodID"), ("DeliveryMethod", "DeliveryMethodName"),
]


def predicates(spark, config, targets):
    known = literal(spark, KNOWN, "table_name string, column_name string")
    wanted = literal(spark, targets, "user_id string, table_name string")
    return {(r.user_id, r.table_name): r.predicate for r in policy.predicate_table(config, wanted, known).collect()}


def test_golden_predicates(spark, seed):
    got = predicates(spark, seed["t_config_rls"], [(u, t) for u, t, _ in GOLDEN])
    assert got == {(u, t): p for u, t, p in GOLDEN}


@pytest.mark.parametrize(
    "value,expected",
    [
        ("a", "f = 'a'"), ("a, b", "f IN ('a','b')"), ("a%", "f LIKE 'a%'"), ("a%,b%", "(f LIKE 'a%' OR f LIKE 'b%')"),
        ("a%,b", "(f LIKE 'a%' OR f IN ('b'))"), ("a,,b", "f IN ('a','','b')"), ("", "1=0"), (None, "1=0"), ("O'x", "f = 'O''x'"),
    ],
)
def test_predicate_of_one_value(spark, value, expected):
    config = literal(spark, [("U", "T", "f", value)], "user_id string, table_name string, field_name string, value string")
    assert predicates(spark, config, [("U", "T")]) == {("U", "T"): expected}


def test_empty_value_adds_nothing_beside_others(spark):
    config = literal(
        spark, [("U", "T", "f", ""), ("U", "T", "g", "x"), ("W", "*", "f", "*"), ("V", "*", "*", None)],
        "user_id string, table_name string, field_name string, value string",
    )
    got = predicates(spark, config, [("U", "T"), ("W", "T"), ("V", "T")])
    assert got == {("U", "T"): "g = 'x'", ("W", "T"): "1=0", ("V", "T"): "1=1"}


def test_column_form_filters_like_the_text(spark, seed):
    vendors = literal(spark, [("VP19", "a"), ("UB55", "b"), ("ZZ", "c")], "VendorID string, VendorName string")
    ways = literal(spark, [(1, "Road North"), (2, "Fast Rail"), (3, "Air")], "DeliveryMethodID int, DeliveryMethodName string")
    assert rows(policy.filter_by_config(vendors, seed["t_config_rls"], "ADV", "Vendor"), "VendorID") == [("UB55",), ("VP19",)]
    assert rows(policy.filter_by_config(ways, seed["t_config_rls"], "ADV", "DeliveryMethod"), "DeliveryMethodID") == [(1,), (2,)]
    assert policy.filter_by_config(vendors, seed["t_config_rls"], "XXX", "Vendor").isEmpty()
    assert policy.filter_by_config(vendors, seed["t_config_rls"], "U31", "Vendor").count() == 3
    seen = policy.config_visibility(vendors, seed["t_config_rls"], "Vendor", ["VendorID"])
    assert rows(seen) == [("ADV", "UB55"), ("ADV", "VP19"), *(("U31", v) for v in ("UB55", "VP19", "ZZ"))]


@pytest.fixture
def guard():
    rules = policy.TablePolicy("customer_profiles", row_commands={"SELECT", "INSERT"})
    for user in ("da_north", "da_south"):
        rules.grant(user, "SELECT", ["profile_id", "full_name", "region"])
        rules.grant(user, "INSERT", ["profile_id", "full_name", "email", "phone_number", "region"])
    return rules


def test_rows_of_own_region_only(seed):
    for user, region in (("da_north", "NORTH"), ("da_south", "SOUTH")):
        got = policy.rows_of_user(seed["customer_profiles"], seed["user_region_mapping"], user)
        assert got.groupBy("region").count().collect()[0].asDict() == {"region": region, "count": 15}
    assert policy.rows_of_user(seed["customer_profiles"], seed["user_region_mapping"], "owner").isEmpty()


def test_columns_outside_the_grant_are_errors(seed, guard):
    granted = guard.require("da_north", "SELECT")
    assert policy.select_columns(seed["customer_profiles"], granted, granted).columns == list(granted)
    for wanted in (["*"], ["profile_id", "email"]):
        with pytest.raises(policy.PolicyError):
            policy.select_columns(seed["customer_profiles"], granted, wanted)


def test_insert_policy_is_all_or_nothing(spark, seed, guard):
    profiles, mapping = seed["customer_profiles"], seed["user_region_mapping"]
    schema = "profile_id int, full_name string, email string, phone_number string, region string"
    south = literal(spark, [(46, "n", "e", "p", "NORTH"), (47, "n", "e", "p", "SOUTH")], schema)
    with pytest.raises(policy.PolicyError):
        policy.checked_insert(profiles, south, guard, mapping, "da_north")
    done = policy.checked_insert(profiles, south.filter("profile_id = 46"), guard, mapping, "da_north")
    assert policy.rows_of_user(done, mapping, "da_north").count() == 16
    with pytest.raises(policy.PolicyError):
        policy.checked_insert(profiles, south.withColumn("extra", F.lit(1)), guard, mapping, "da_north")


def test_commands_without_policy_are_denied(guard):
    for user, command in (("da_north", "UPDATE"), ("da_north", "DELETE"), ("stranger", "SELECT")):
        with pytest.raises(policy.PolicyError):
            guard.require(user, command)
    guard.revoke_all("da_north")
    with pytest.raises(policy.PolicyError):
        guard.require("da_north", "SELECT")


def test_caller_and_owner_rights(seed, guard):
    columns = ["profile_id", "full_name", "region"]
    args = (seed["customer_profiles"], guard, seed["user_region_mapping"], "da_north", "SOUTH", columns)
    assert policy.profiles_by_region(*args).count() == 0
    assert policy.profiles_by_region(*args, run_as="owner").count() == 15


def test_view_and_listing(spark, seed, guard):
    policy.safe_view(seed["customer_profiles"], guard, seed["user_region_mapping"], "da_south", "v_safe")
    assert spark.sql("SELECT DISTINCT region FROM v_safe").collect()[0][0] == "SOUTH"
    assert "email" not in spark.table("v_safe").columns
    listing = guard.listing(spark)
    assert listing.filter("grantee = 'da_north' AND command = 'SELECT'").count() == 3
    assert rows(listing.filter("kind = 'row'"), "command") == [("INSERT",), ("SELECT",)]


def python_sees(rules, row):
    """Brute force of the decision order for one user and a table ``T`` with columns a and b."""
    own = [r for r in rules if r[0] in ("T", "*")]
    if any(t == "*" and f == "*" for t, f, _ in own):
        return True
    if any(t == "T" and (f == "*" or v == "*") for t, f, v in own):
        return True
    conditions = []
    for t, f, v in own:
        if f == "*" or v == "*" or (t == "*" and f.lower() not in ("a", "b")):
            continue
        entries = [e.strip(" ") for e in v.split(",")] if v else []
        if entries:
            # A column the table lacks, and a pattern with a stray escape, meet no row.
            text = row.get(f.lower())
            like = [".*".join(re.escape(x).replace("_", ".") for x in e.split("%")) if "\\" not in e else "(?!)" for e in entries]
            conditions.append(text is not None and any(re.fullmatch(p, text) if "%" in e else text == e for e, p in zip(entries, like, strict=True)))
    return bool(conditions) and all(conditions)


def test_random_configurations_against_brute_force(spark):
    rng = random.Random(11)
    values = ["x", "xy", "y", "z", "x%", "%y", "%", "x,y", "x, z%", "", "*", "zz,xy"]
    config = []
    for user in range(60):
        for _ in range(rng.randrange(1, 4)):
            config.append((f"U{user}", rng.choice(["T", "T", "T", "*", "S"]), rng.choice(["a", "A", "b", "a", "B", "*"]) if rng.random() < 0.9 else "c", rng.choice(values)))
    config += [("U60", "T", "c", "x"), ("U60", "T", "a", "x%"), ("U61", "T", "a", "x\\\\q%"), ("U62", "T", "a", "_y%"), ("U63", "*", "*", "*")]
    data = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in ("x", "xy", "y", "z", "zz", "") for b in ("x", "y", "xy"))]
    df = literal(spark, data, "id int, a string, b string")
    rules = literal(spark, config, "user_id string, table_name string, field_name string, value string")
    expected = {
        (f"U{u}", i) for u in range(64) for i, a, b in data if python_sees([c[1:] for c in config if c[0] == f"U{u}"], {"a": a, "b": b})
    }
    seen = policy.config_visibility(df, rules, "T", ["id"])
    assert {tuple(r) for r in seen.collect()} == expected
    counts = {r.user_id: r.n_rows for r in policy.visibility_counts(df, rules, "T").collect()}
    assert counts == {u: sum(1 for e in expected if e[0] == u) for u in {c[0] for c in config}}
    # The text form names columns as the rules do, so it is read only where the table has them.
    bad = {u for u, t, f, v in config if t == "T" and f == "c" or "\\" in v}
    rules = rules.filter(~F.col("user_id").isin(sorted(bad)))
    expected = {e for e in expected if e[0] not in bad}
    known = literal(spark, [("T", "a"), ("T", "b"), ("T", "id")], "table_name string, column_name string")
    texts = policy.predicate_table(rules, rules.select("user_id", F.lit("T").alias("table_name")), known).collect()
    marks = df.select("id", *[F.expr(r.predicate).alias(r.user_id) for r in texts]).collect()
    assert {(r.user_id, m.id) for r in texts for m in marks if m[r.user_id]} == expected


def test_visibility_reads_the_data_once_for_any_number_of_rule_sets(spark, tmp_path):
    df = literal(spark, [(i, f"v{i % 50}", None if i % 9 == 0 else i % 7) for i in range(400)], "id int, a string, b int")
    df.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    config = [(f"U{k}", "T", f, v) for k in range(300) for f, v in (("a", f"v{k % 50}, %{k}"), ("b", str(k % 8)))]
    rules = literal(spark, config, "user_id string, table_name string, field_name string, value string")
    counts = {r.user_id: r.n_rows for r in policy.visibility_counts(stored, rules, "T").collect()}
    data = [(r.a, r.b) for r in df.collect()]
    assert counts == {f"U{k}": sum((a == f"v{k % 50}" or a.endswith(str(k))) and b == k % 8 for a, b in data) for k in range(300)}
    nothing = literal(spark, [], "id int, a string, b int")
    assert policy.config_visibility(nothing, rules, "T", ["id"]).count() == 0
    assert {r.n_rows for r in policy.visibility_counts(nothing, rules, "T").collect()} == {0}
    only_all = rules.limit(0).unionByName(literal(spark, [("A", "*", "*", "*"), ("B", "S", "x", "y")], "user_id string, table_name string, field_name string, value string"))
    assert policy.config_visibility(stored, only_all, "T", ["id"]).groupBy("user_id").count().collect() == [("A", 400)]
