"""Row and column policies as filtered DataFrames.

These shape what a job hands on; they are not access control. Whoever can read the files can go
around them, so storage permissions stay with the platform.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.functions.predicates import all_of, any_true, contains_percent
from promoledger.functions.scalars import split_list
from promoledger.session import materialize
from promoledger.sources.literal import literal

ALLOW, DENY = "1=1", "1=0"


class PolicyError(PermissionError):
    """The policy forbids the request."""


@dataclass
class TablePolicy:
    """Grants on one table: columns per (user, command) and the commands that have a row policy."""

    table: str
    columns: dict[tuple[str, str], tuple[str, ...]] = field(default_factory=dict)
    row_commands: set[str] = field(default_factory=set)
    row_column: str = "region"

    def grant(self, user: str, command: str, columns: Sequence[str]) -> None:
        self.columns[(user, command)] = tuple(columns)

    def revoke_all(self, user: str) -> None:
        self.columns = {k: v for k, v in self.columns.items() if k[0] != user}

    def require(self, user: str, command: str) -> tuple[str, ...]:
        """Columns the user may touch with the command; no grant or row policy means denied."""
        if command not in self.row_commands or (user, command) not in self.columns:
            raise PolicyError(f"permission denied: {command} on {self.table} for {user}")
        return self.columns[(user, command)]

    def listing(self, spark: SparkSession) -> DataFrame:
        rows = [(u, self.table, cmd, "column", c) for (u, cmd), cs in self.columns.items() for c in cs]
        rows += [("PUBLIC", self.table, cmd, "row", self.row_column) for cmd in sorted(self.row_commands)]
        return literal(spark, rows, "grantee string, table_name string, command string, kind string, target string")


def select_columns(df: DataFrame, granted: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Projection under a column grant. A column outside the grant (or ``*``) is an error."""
    names = df.columns if "*" in wanted else list(wanted)
    denied = [c for c in names if c not in granted]
    if denied:
        raise PolicyError(f"permission denied for columns {denied}")
    return df.select(*names)


def rows_of_user(df: DataFrame, mapping: DataFrame, user: str, column: str = "region") -> DataFrame:
    """Rows of the user's own region. A user without a mapping, owner included, sees none."""
    own = mapping.filter(F.col("username") == user).select(F.col("assigned_region").alias(column))
    return df.join(own, column, "left_semi").select(df.columns)


def visible_counts(df: DataFrame, mapping: DataFrame, column: str = "region") -> DataFrame:
    """Rows visible to each mapped user: counted per region first, so no (user, row) pair is formed."""
    counts = df.groupBy(F.col(column).alias("assigned_region")).agg(F.count(F.lit(1)).alias("n_rows"))
    joined = mapping.join(counts, "assigned_region", "left")
    return joined.select("username", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def rejected_inserts(batch: DataFrame, mapping: DataFrame, user: str, column: str = "region") -> DataFrame:
    """Rows of an insert batch outside the user's region."""
    own = mapping.filter(F.col("username") == user).select(F.col("assigned_region").alias(column))
    return batch.join(own, column, "left_anti").select(batch.columns)


def checked_insert(
    target: DataFrame, batch: DataFrame, policy: TablePolicy, mapping: DataFrame, user: str
) -> DataFrame:
    """Append a batch under column and row policy; one row outside fails the whole batch."""
    granted = policy.require(user, "INSERT")
    denied = [c for c in batch.columns if c not in granted]
    if denied:
        raise PolicyError(f"permission denied for columns {denied}")
    if not rejected_inserts(batch, mapping, user, policy.row_column).isEmpty():
        raise PolicyError(f"new row violates row policy of {policy.table}")
    return target.unionByName(batch, allowMissingColumns=True)


def profiles_by_region(
    df: DataFrame, policy: TablePolicy, mapping: DataFrame, user: str, region: str, columns: Sequence[str],
    run_as: str = "caller",
) -> DataFrame:
    """Parametrised read. As the caller both policies apply; as the owner the row policy is skipped,
    which leaks other regions and exists to show just that."""
    if run_as not in ("caller", "owner"):
        raise ValueError(run_as)
    granted = policy.require(user, "SELECT") if run_as == "caller" else columns
    rows = rows_of_user(df, mapping, user, policy.row_column) if run_as == "caller" else df
    return select_columns(rows.filter(F.col(policy.row_column) == region), granted, columns)


def safe_view(df: DataFrame, policy: TablePolicy, mapping: DataFrame, user: str, name: str | None = None) -> DataFrame:
    """Granted columns of the visible rows, optionally registered as a temporary view."""
    view = rows_of_user(df, mapping, user, policy.row_column).select(*policy.require(user, "SELECT"))
    if name:
        view.createOrReplaceTempView(name)
    return view


# ---- predicates from a configuration table ----------------------------------------------------
# A configuration row is (user_id, table_name, field_name, value); value is a comma list in which
# entries with a percent sign are patterns. Decision order, fixed by the data contract:
#   any row ('*', '*') of the user                      -> everything
#   a row of the table with field '*' or value '*'      -> whole table
#   else rows for the table, or for table '*' if the table has that column, joined by AND
#   no such row                                         -> nothing
# An empty value adds no condition; a user whose only rows are empty sees nothing.


def user_rules(config: DataFrame, targets: DataFrame, columns: DataFrame) -> DataFrame:
    """Rules that apply to each (user_id, table_name) target.

    Result: one row per target and applicable rule with ``kind`` = allow or field.
    """
    wanted = targets.select("user_id", "table_name").distinct()
    rules = config.select("user_id", F.col("table_name").alias("scope"), "field_name", "value")
    known = columns.select("table_name", F.lower("column_name").alias("__column")).distinct()
    pairs = wanted.join(rules, "user_id").filter((F.col("scope") == F.col("table_name")) | (F.col("scope") == "*"))
    everything = (F.col("scope") == "*") & (F.col("field_name") == "*")
    whole_table = (F.col("scope") == F.col("table_name")) & ((F.col("field_name") == "*") | (F.col("value") == "*"))
    field_rule = (F.col("field_name") != "*") & (F.col("value") != "*")
    kind = F.when(everything | whole_table, "allow").when(field_rule, "field")
    usable = pairs.withColumn("kind", kind).filter(F.col("kind").isNotNull())
    checked = usable.withColumn("__column", F.lower("field_name")).join(
        known.withColumn("__known", F.lit(True)), ["table_name", "__column"], "left"
    )
    keep = (F.col("kind") == "allow") | (F.col("scope") != "*") | F.col("__known").isNotNull()
    return checked.filter(keep).select("user_id", "table_name", "kind", "field_name", "value")


def _with_condition_text(rules: DataFrame) -> DataFrame:
    """Add ``__text``: SQL text of the rule in ``field_name`` and ``value``; NULL when the value is empty."""

    def quoted(v: Column) -> Column:
        return F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'"))

    def like(v: Column) -> Column:
        return F.concat(F.col("field_name"), F.lit(" LIKE "), quoted(v))

    split = rules.withColumn("__values", split_list(F.col("value"))).withColumns(
        {
            "__likes": F.transform(F.filter("__values", contains_percent), like),
            "__plain": F.transform(F.filter("__values", lambda v: ~contains_percent(v)), quoted),
        }
    )
    n_like, n_plain = F.size("__likes"), F.size("__plain")
    ors = F.array_join("__likes", " OR ")
    in_list = F.concat(F.col("field_name"), F.lit(" IN ("), F.array_join("__plain", ","), F.lit(")"))
    text = (
        F.when((n_like > 0) & (n_plain > 0), F.concat(F.lit("("), ors, F.lit(" OR "), in_list, F.lit(")")))
        .when(n_like > 1, F.concat(F.lit("("), ors, F.lit(")")))
        .when(n_like == 1, ors)
        .when(n_plain > 1, in_list)
        .when(n_plain == 1, F.concat(F.col("field_name"), F.lit(" = "), F.get("__plain", 0)))
    )
    return split.withColumn("__text", text)


def predicate_table(config: DataFrame, targets: DataFrame, columns: DataFrame) -> DataFrame:
    """SQL text of the row predicate of every (user_id, table_name) target, as a report.

    The text is for reading and comparing; filtering uses ``predicate_column``.
    """
    rules = _with_condition_text(user_rules(config, targets, columns))
    part = F.when((F.col("kind") == "field") & F.col("__text").isNotNull(), F.struct("field_name", "value", "__text"))
    grouped = rules.groupBy("user_id", "table_name").agg(
        F.max(F.col("kind") == "allow").alias("__allow"), F.sort_array(F.collect_list(part)).alias("__parts")
    )
    text = F.when(F.col("__allow"), ALLOW).when(
        F.size("__parts") > 0, F.array_join(F.transform("__parts", lambda p: p["__text"]), " AND ")
    )
    wanted = targets.select("user_id", "table_name").distinct()
    return wanted.join(grouped.withColumn("__p", text), ["user_id", "table_name"], "left").select(
        "user_id", "table_name", F.coalesce("__p", F.lit(DENY)).alias("predicate")
    )


def _rule_column(field_name: str, value: str) -> Column:
    entries = [v.strip(" ") for v in value.split(",")]
    parts = [F.col(f"`{field_name}`").like(v) for v in entries if "%" in v]
    plain = [v for v in entries if "%" not in v]
    if plain:
        parts.append(F.col(f"`{field_name}`").isin(plain))
    return any_true(parts)


def _set_column(rule_set: str) -> Column:
    if rule_set in (ALLOW, DENY):
        return F.lit(rule_set == ALLOW)
    return all_of([_rule_column(r["field_name"], r["value"]) for r in json.loads(rule_set)])


def rule_sets(config: DataFrame, table: str, df: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """(user_id, rule_set): what each user may see of one table, as ``1=1``, ``1=0`` or a JSON list of
    (field_name, value) rules. Users with the same rules share one text."""
    spark = df.sparkSession
    wanted = (config if users is None else users).select("user_id").distinct()
    known = literal(spark, [(table, c) for c in df.columns], "table_name string, column_name string")
    rules = user_rules(config, wanted.withColumn("table_name", F.lit(table)), known)
    part = F.when((F.col("kind") == "field") & (F.col("value") != ""), F.struct("field_name", "value"))
    grouped = rules.groupBy("user_id").agg(
        F.max(F.col("kind") == "allow").alias("__allow"), F.sort_array(F.collect_set(part)).alias("__parts")
    )
    text = F.when(F.col("__allow"), ALLOW).when(F.size("__parts") > 0, F.to_json("__parts")).otherwise(DENY)
    sets = grouped.select("user_id", text.alias("rule_set"))
    return wanted.join(sets, "user_id", "left").select("user_id", F.coalesce("rule_set", F.lit(DENY)).alias("rule_set"))


def predicate_column(config: DataFrame, user: str, table: str, df: DataFrame) -> Column:
    """The predicate of one user on one table as a Column tree: no SQL text, nothing to inject.

    One row, the user's own rules, comes to the driver.
    """
    asked = literal(df.sparkSession, [(user,)], "user_id string")
    return _set_column(rule_sets(config, table, df, asked).first()["rule_set"])


def filter_by_config(df: DataFrame, config: DataFrame, user: str, table: str) -> DataFrame:
    """Rows of ``df`` one user may see under the configuration."""
    return df.filter(predicate_column(config, user, table, df))


# The configuration of many users is used as an index: each distinct rule set becomes rows (set, rule,
# field, entry), which meet the distinct values of the data in equi-joins. Equal entries join on the value,
# patterns on a piece of their literal text; a set is met where as many rules are met as it has.

_ALL_ROWS, _NO_ROWS = -1, -2
_PREFIX, _GRAM = 8, 3


@dataclass(frozen=True)
class RuleIndex:
    """``members`` (user_id, set_no), ``rules`` (set_no, rule_no, field, entry), ``sizes`` (set_no, n_rules) and the table's columns in use."""

    members: DataFrame
    rules: DataFrame
    sizes: DataFrame
    fields: list[str]


def rule_index(config: DataFrame, table: str, df: DataFrame) -> RuleIndex:
    """The rule sets of all configured users on one table. Users with the same rules share a set; nothing but
    the names of the table's own columns in use comes to the driver."""
    users = materialize(rule_sets(config, table, df), "rule-sets")
    number = F.when(F.col("rule_set") == ALLOW, _ALL_ROWS).when(F.col("rule_set") == DENY, _NO_ROWS).otherwise(F.monotonically_increasing_id())
    sets = materialize(users.select("rule_set").distinct().withColumn("set_no", number), "distinct-sets")
    parsed = F.from_json("rule_set", "array<struct<field_name:string,value:string>>")
    listed = sets.filter(F.col("set_no") >= 0).select("set_no", F.posexplode(parsed).alias("rule_no", "rule"))
    rules = listed.select("set_no", "rule_no", F.lower("rule.field_name").alias("field"), F.explode(F.array_distinct(split_list(F.col("rule.value")))).alias("entry"))
    sizes = listed.groupBy("set_no").agg(F.count(F.lit(1)).alias("n_rules"))
    used = rules.select("field").filter(F.col("field").isin([c.lower() for c in df.columns])).distinct().collect()
    names = {r["field"] for r in used}
    return RuleIndex(users.join(sets, "rule_set").select("user_id", "set_no"), rules, sizes, [c for c in df.columns if c.lower() in names])


def _anchor(entry: Column) -> Column:
    """The literal text a pattern is looked up by: its beginning, or the first letters of its longest literal part."""
    prefix = F.regexp_extract(entry, r"^([^%_\\]*)", 1)
    longest = F.aggregate(F.split(entry, r"[%_\\]+"), F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))
    at_start = F.concat(F.lit("p"), F.least(F.length(prefix), F.lit(_PREFIX)), F.lit(":"), F.substring(prefix, 1, _PREFIX))
    inside = F.concat(F.lit("g"), F.least(F.length(longest), F.lit(_GRAM)), F.lit(":"), F.substring(longest, 1, _GRAM))
    return F.when(F.length(prefix) > 0, at_start).otherwise(inside)


def _anchors_of_kind(value: Column, kind: str) -> Column:
    size, tag = int(kind[1:]), F.lit(f"{kind}:")
    if kind[0] == "p":
        return F.array(F.concat(tag, F.substring(value, 1, size)))
    if size == 0:
        return F.array(tag)
    starts = F.sequence(F.lit(1), F.greatest(F.length(value) - size + 1, F.lit(1)))
    return F.transform(starts, lambda k: F.concat(tag, F.substr(value, k, F.lit(size))))


def _anchors_of_value(value: Column, kinds: Sequence[str]) -> Column:
    """Every anchor of the given kinds that a value can be found by."""
    return F.array_distinct(F.concat(*[_anchors_of_kind(value, kind) for kind in sorted(kinds)]))


def _hits(rules: DataFrame, values: DataFrame) -> DataFrame:
    """(set_no, rule_no, field, value) for every rule and each value of its field that meets it."""
    equal = rules.filter(~contains_percent(F.col("entry"))).withColumnRenamed("entry", "value").join(values, ["field", "value"])
    # A pattern with a stray escape meets nothing, and so shuts out its own users only.
    sound = contains_percent(F.col("entry")) & F.col("entry").rlike(r"^(?s)([^\\]|\\[%_\\])*$")
    patterns = rules.filter(sound).withColumn("__anchor", _anchor(F.col("entry")))
    kinds = [r["kind"] for r in patterns.select(F.substring_index("__anchor", ":", 1).alias("kind")).distinct().collect()]
    columns = ["set_no", "rule_no", "field", "value"]
    if not kinds:
        return equal.select(columns)
    # Each distinct pattern is tested once per value it may match, then given to its rules.
    known = patterns.select("field", "entry", "__anchor").distinct()
    found = values.withColumn("__anchor", F.explode(_anchors_of_value(F.col("value"), kinds))).join(known, ["field", "__anchor"])
    met = found.filter(F.expr("value LIKE entry")).select("field", "value", "entry")
    like = patterns.join(met, ["field", "entry"])
    return equal.select(columns).unionByName(like.select(columns)).distinct()


def _met_sets(index: RuleIndex, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(distinct values of the ruled columns with ``combo`` and ``n_rows``, (combo, set_no) of every set they meet)."""
    texts = [F.col(f"`{c}`").cast("string").alias(f"__v{i}") for i, c in enumerate(index.fields)]
    counted = df.select(*texts, F.lit(1).alias("__one")).groupBy(*[f"__v{i}" for i in range(len(texts))]).agg(F.count("__one").alias("n_rows"))
    combos = materialize(counted.withColumn("combo", F.monotonically_increasing_id()), "combos")
    if index.fields:
        pairs = F.array(*[F.struct(F.lit(c.lower()).alias("field"), F.col(f"__v{i}").alias("value")) for i, c in enumerate(index.fields)])
        cells = combos.select("combo", F.inline(pairs)).filter(F.col("value").isNotNull())
        hits = materialize(_hits(index.rules, cells.select("field", "value").distinct()), "rule-hits")
        met = cells.join(hits, ["field", "value"]).groupBy("combo", "set_no").agg(F.count(F.lit(1)).alias("n_met"))
        met = met.join(index.sizes, "set_no").filter(F.col("n_met") == F.col("n_rules")).select("combo", "set_no")
    else:
        met = combos.select("combo", F.lit(_NO_ROWS).cast("bigint").alias("set_no")).filter(F.lit(False))
    return combos, met.unionByName(combos.select("combo", F.lit(_ALL_ROWS).cast("bigint").alias("set_no")))


def config_visibility(df: DataFrame, config: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """(user_id, key...) for every configured user and each row the user may see, users with full access included.

    The data is read once, whatever the number of rule sets. Values compare as text. A rule on a column
    the table lacks, or a pattern Spark cannot read, shuts out its own users and no one else.
    """
    index = rule_index(config, table, df)
    combos, met = _met_sets(index, df)
    seen = met.join(index.members, "set_no")
    texts = [F.col(f"`{c}`").cast("string").eqNullSafe(F.col(f"__v{i}")) for i, c in enumerate(index.fields)]
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), *[F.col(f"`{c}`") for c in index.fields])
    # Without a ruled column all rows are one combination.
    placed = row.join(combos.drop("n_rows"), all_of(texts)) if texts else row.withColumn("combo", F.lit(combos.first()["combo"]))
    return placed.join(seen, "combo").select("user_id", *[F.col(f"__row.`{k}`").alias(k) for k in key])


def visibility_counts(df: DataFrame, config: DataFrame, table: str) -> DataFrame:
    """Rows visible to each configured user: counted per rule set over the distinct ruled values, then given to its users."""
    index = rule_index(config, table, df)
    combos, met = _met_sets(index, df)
    counts = met.join(combos.select("combo", "n_rows"), "combo").groupBy("set_no").agg(F.sum("n_rows").alias("n_rows"))
    return index.members.join(counts, "set_no", "left").select("user_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
