"""Row and column policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.operators import policy
from promoledger.plans.sql_functions import register_profile_reader
from promoledger.sources.literal import literal
from promoledger.workload.views import sql, table, view

QUERIES, ORACLE = {}, {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = oracle
        return fn

    return register


def _policy() -> policy.TablePolicy:
    rules = policy.TablePolicy("profiles", row_commands={"SELECT", "INSERT"})
    for user in ("da_asia", "da_europe"):
        rules.grant(user, "SELECT", ["profile_id", "full_name", "region"])
        rules.grant(user, "INSERT", ["profile_id", "full_name", "email", "region"])
    return rules


@query(sql("SELECT profile_id, full_name, region FROM profiles", "profiles"))
def column_policy(spark, sf):
    granted = _policy().require("da_asia", "SELECT")
    return policy.select_columns(view(spark, sf, "profiles"), granted, ["profile_id", "full_name", "region"])


@query(sql("SELECT profile_id, full_name, email, region FROM profiles WHERE region = 'ASIA'", "profiles"))
def row_policy(spark, sf):
    return policy.rows_of_user(view(spark, sf, "profiles"), view(spark, sf, "mapping"), "da_asia")


@query(sql("SELECT profile_id, full_name, email, region FROM profiles WHERE FALSE", "profiles"))
def row_policy_unmapped(spark, sf):
    return policy.rows_of_user(view(spark, sf, "profiles"), view(spark, sf, "mapping"), "owner")


@query(
    sql("SELECT username, count(*) AS n_rows FROM profiles JOIN mapping ON region = assigned_region GROUP BY username", "profiles", "mapping")
)
def row_policy_all_users(spark, sf):
    return policy.visible_counts(view(spark, sf, "profiles"), view(spark, sf, "mapping"))


@query(sql("SELECT region, count(*) AS total FROM profiles GROUP BY region", "profiles"))
def profiles_per_region(spark, sf):
    return view(spark, sf, "profiles").groupBy("region").agg(F.count(F.lit(1)).alias("total"))


@query(sql("SELECT profile_id, region FROM profiles WHERE region <> 'EUROPE'", "profiles"))
def insert_policy_rejects(spark, sf):
    rejected = policy.rejected_inserts(view(spark, sf, "profiles"), view(spark, sf, "mapping"), "da_europe")
    return rejected.select("profile_id", "region")


@query(
    sql(
        "SELECT profile_id, full_name, email, region FROM profiles UNION ALL "
        "SELECT profile_id + 10000000, concat('new ', full_name), NULL, region FROM profiles WHERE region = 'EUROPE'",
        "profiles",
    )
)
def column_checked_insert(spark, sf):
    """A user adds rows of the own region with granted columns only; a column left out is NULL."""
    profiles = view(spark, sf, "profiles")
    added = profiles.filter("region = 'EUROPE'").select((F.col("profile_id") + 10_000_000).alias("profile_id"), F.concat(F.lit("new "), "full_name").alias("full_name"), "region")
    stored = policy.checked_insert(profiles, added, _policy(), view(spark, sf, "mapping"), "da_europe")
    return stored.select("profile_id", "full_name", "email", "region")


def _by_region(spark, sf, run_as):
    return policy.profiles_by_region(
        view(spark, sf, "profiles"), _policy(), view(spark, sf, "mapping"), "da_asia", "EUROPE", ["profile_id", "full_name", "region"], run_as
    )


@query(sql("SELECT profile_id, full_name, region FROM profiles WHERE region = 'EUROPE' AND region = 'ASIA'", "profiles"))
def caller_rights_read(spark, sf):
    return _by_region(spark, sf, "caller")


@query(sql("SELECT profile_id, full_name, region FROM profiles WHERE region = 'ASIA'", "profiles"))
def profile_reader_sql(spark, sf):
    for name in ("profiles", "mapping"):
        view(spark, sf, name).createOrReplaceTempView(f"__promoledger_{name}")
    register_profile_reader(spark, "__promoledger_profiles", "__promoledger_mapping")
    own = "SELECT * FROM customer_profiles_of_region('da_asia', 'ASIA')"
    other = "SELECT * FROM customer_profiles_of_region('da_asia', 'EUROPE')"
    return spark.sql(f"{own} UNION ALL {other}")


@query(sql("SELECT profile_id, full_name, region FROM profiles WHERE region = 'EUROPE'", "profiles"))
def owner_rights_read(spark, sf):
    return _by_region(spark, sf, "owner")


@query(sql("SELECT profile_id, full_name, region FROM profiles WHERE region = 'EUROPE'", "profiles"))
def safe_view(spark, sf):
    return policy.safe_view(view(spark, sf, "profiles"), _policy(), view(spark, sf, "mapping"), "da_europe", "__promoledger_safe_profiles")


# ---- predicates from configuration --------------------------------------------------------------

_CONFIG = [
    ("U01", "part", "p_brand", "Brand#1,Brand#2"),
    ("U01", "part", "P_Type", "PROMO, SMALL"),
    ("U02", "part", "p_name", "red%,%bolt"),
    ("U03", "part", "p_name", "blue%,small ring"),
    ("U04", "part", "p_type", "ECONOMY"),
    ("U05", "*", "*", "*"),
    ("U06", "part", "*", "x"),
    ("U07", "part", "p_brand", "Brand#3"),
    ("U07", "part", "p_size", "*"),
    ("U08", "*", "p_brand", "Brand#4"),
    ("U08", "*", "c_name", "Customer%"),
    ("U09", "supplier", "s_name", "%1"),
    ("U10", "part", "p_brand", ""),
    ("U11", "*", "p_type", "*"),
]
_COLUMNS = "user_id string, table_name string, field_name string, value string"
_SEES = {
    "U01": "p_type IN ('PROMO', 'SMALL') AND p_brand IN ('Brand#1', 'Brand#2')",
    "U02": "p_name LIKE 'red%' OR p_name LIKE '%bolt'",
    "U03": "p_name LIKE 'blue%' OR p_name IN ('small ring')",
    "U04": "p_type = 'ECONOMY'",
    "U08": "p_brand = 'Brand#4'",
}
_SEES_ALL = {**_SEES, "U05": "TRUE", "U06": "TRUE", "U07": "TRUE", "U09": "FALSE", "U10": "FALSE", "U11": "FALSE"}


@query(" UNION ALL ".join(f"SELECT '{u}' AS user_id, p_partkey FROM part WHERE {p}" for u, p in _SEES_ALL.items()))
def config_visibility(spark, sf):
    return policy.config_visibility(table(spark, sf, "part"), literal(spark, _CONFIG, _COLUMNS), "part", ["p_partkey"])


@query(f"SELECT p_partkey, p_name, p_brand, p_type FROM part WHERE {_SEES['U01']}")
def config_filter(spark, sf):
    rows = policy.filter_by_config(table(spark, sf, "part"), literal(spark, _CONFIG, _COLUMNS), "U01", "part")
    return rows.select("p_partkey", "p_name", "p_brand", "p_type")


@query(" UNION ALL ".join(f"SELECT '{u}' AS user_id, count(*) FILTER (WHERE {p}) AS n_rows FROM part" for u, p in _SEES_ALL.items()))
def config_visible_counts(spark, sf):
    return policy.visibility_counts(table(spark, sf, "part"), literal(spark, _CONFIG, _COLUMNS), "part")


# A configuration derived from the data: the clerk of each customer name sees the parts of the brands
# bought, patterns from the segment. Grows with the customer table.
_DERIVED_SQL = (
    "SELECT c_name AS user_id, CASE WHEN c_acctbal < 0 THEN '*' WHEN c_nationkey < 5 THEN 'supplier' ELSE 'part' END AS table_name, "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'p_size' WHEN c_mktsegment = 'BUILDING' THEN 'no_such' ELSE 'p_brand' END AS field_name, "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN '1, 2' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Brand#%' WHEN c_nationkey > 20 THEN '*' "
    "ELSE concat('Brand#', c_nationkey) END AS value FROM customer"
)


def _derived_config(spark, sf):
    customer = table(spark, sf, "customer")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    return customer.select(
        F.col("c_name").alias("user_id"),
        F.when(F.col("c_acctbal") < 0, "*").when(nation < 5, "supplier").otherwise("part").alias("table_name"),
        F.when(segment == "MACHINERY", "p_size").when(segment == "BUILDING", "no_such").otherwise("p_brand").alias("field_name"),
        F.when(segment == "MACHINERY", "1, 2")
        .when(segment == "HOUSEHOLD", "Brand#%")
        .when(nation > 20, "*")
        .otherwise(F.concat(F.lit("Brand#"), nation))
        .alias("value"),
    )


_DERIVED_TEXT = (
    "CASE WHEN table_name = 'part' AND value = '*' THEN '1=1' WHEN table_name = 'part' AND field_name = 'p_size' THEN 'p_size IN (''1'',''2'')' "
    "WHEN table_name = '*' AND field_name = 'p_size' THEN 'p_size IN (''1'',''2'')' "
    "WHEN table_name = 'supplier' OR (table_name = '*' AND (field_name = 'no_such' OR value = '*')) THEN '1=0' "
    "WHEN value LIKE '%~%%' ESCAPE '~' THEN concat(field_name, ' LIKE ''', value, '''') ELSE concat(field_name, ' = ''', value, '''') END"
)


@query(f"SELECT user_id, 'part' AS table_name, {_DERIVED_TEXT} AS predicate FROM ({_DERIVED_SQL})")
def predicate_table(spark, sf):
    config = _derived_config(spark, sf)
    targets = config.select("user_id", F.lit("part").alias("table_name"))
    known = literal(spark, [("part", c) for c in table(spark, sf, "part").columns], "table_name string, column_name string")
    return policy.predicate_table(config, targets, known)


@query(
    f"SELECT user_id, CASE WHEN p = '1=1' THEN (SELECT count(*) FROM part) WHEN p = '1=0' OR starts_with(p, 'no_such') THEN 0 "
    "WHEN field_name = 'p_size' THEN (SELECT count(*) FROM part WHERE p_size IN (1, 2)) "
    "WHEN value = 'Brand#%' THEN (SELECT count(*) FROM part WHERE p_brand LIKE 'Brand#%') ELSE coalesce(n, 0) END AS n_rows FROM "
    f"(SELECT *, {_DERIVED_TEXT} AS p FROM ({_DERIVED_SQL})) LEFT JOIN "
    "(SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) ON p_brand = value"
)
def config_counts_many_users(spark, sf):
    """One user per customer; a rule on a column the table lacks shuts out its user alone."""
    return policy.visibility_counts(table(spark, sf, "part"), _derived_config(spark, sf), "part")


# A configuration with as many rule sets as customers: two rules each, patterns of every form.
_OWN_RULES_SQL = (
    "SELECT c_name, r, CASE r WHEN 0 THEN 'p_name' ELSE 'p_brand' END AS field_name, CASE WHEN r = 1 THEN "
    "concat('Brand#', c_custkey % 5 + 1, ', Brand#', c_custkey % 7 + 1) WHEN c_custkey % 4 = 0 THEN concat('%', lower(left(c_mktsegment, 1)), '%') "
    "WHEN c_custkey % 4 = 1 THEN concat(chr(CAST(97 + c_custkey % 26 AS INTEGER)), '%') WHEN c_custkey % 4 = 2 THEN concat('%', chr(CAST(97 + c_custkey % 26 AS INTEGER))) "
    "ELSE concat('%', substr('redblue small', CAST(1 + c_custkey % 9 AS INTEGER), 3), '%') END AS value FROM customer, (VALUES (0), (1)) t(r)"
)


def _own_rules(spark, sf):
    key, letter = F.col("c_custkey"), F.char((97 + F.col("c_custkey") % 26).cast("bigint"))
    pattern = (
        F.when(key % 4 == 0, F.concat(F.lit("%"), F.lower(F.substring("c_mktsegment", 1, 1)), F.lit("%")))
        .when(key % 4 == 1, F.concat(letter, F.lit("%")))
        .when(key % 4 == 2, F.concat(F.lit("%"), letter))
        .otherwise(F.concat(F.lit("%"), F.substr(F.lit("redblue small"), (1 + key % 9).cast("int"), F.lit(3)), F.lit("%")))
    )
    brands = F.concat(F.lit("Brand#"), key % 5 + 1, F.lit(", Brand#"), key % 7 + 1)
    rules = F.array(F.struct(F.lit("p_name").alias("field_name"), pattern.alias("value")), F.struct(F.lit("p_brand").alias("field_name"), brands.alias("value")))
    return table(spark, sf, "customer").select(F.col("c_name").alias("user_id"), F.lit("part").alias("table_name"), F.inline(rules))


@query(
    f"SELECT a.c_name AS user_id, (SELECT count(*) FROM part WHERE p_name LIKE a.value AND list_contains(string_split(b.value, ', '), p_brand)) AS n_rows "
    f"FROM ({_OWN_RULES_SQL}) a JOIN ({_OWN_RULES_SQL}) b ON a.c_name = b.c_name AND a.r = 0 AND b.r = 1"
)
def config_counts_own_rules(spark, sf):
    """Every customer has rules of its own: one pattern on the name and two brands."""
    return policy.visibility_counts(table(spark, sf, "part"), _own_rules(spark, sf), "part")
