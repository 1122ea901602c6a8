"""Constraint checks over whole tables.

A row gets the names of the rules it breaks in one array column (``bad``). NULL semantics are those
of SQL constraints: a check whose outcome is NULL passes, a NULL foreign key passes, and NULLs never
collide in a unique key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.functions.predicates import any_true, holds
from promoledger.operators.relational import blocked_parents, missing_parents
from promoledger.functions.joins import null_safe_join
from promoledger.session import materialize
from promoledger.sources.schemas import Check, Table
from promoledger.sources.literal import literal

BAD = "bad"


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame


def flag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``bad``: names of the violated rules. ``rules`` maps a name to a condition that must hold.

    One projection, no shuffle.
    """
    names = [F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules.items()]
    broken = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn(BAD, broken)


def row_rules(table: Table) -> dict[str, Column]:
    """NOT NULL, length and CHECK rules of a table as named conditions."""
    rules: dict[str, Column] = {}
    for c in table.columns:
        if c.required:
            rules[f"{table.name}_{c.name}_not_null"] = F.col(c.name).isNotNull()
        if c.length is not None:
            rules[f"{table.name}_{c.name}_length"] = F.length(c.name) <= c.length
    rules.update({c.name: F.expr(c.expr) for c in table.checks})
    return rules


def decimal_fits(text: Column, precision: int, scale: int) -> Column:
    """Can the text be stored as this decimal without losing its integer digits?"""
    return text.isNull() | text.try_cast(T.DecimalType(precision, scale)).isNotNull()


def flag_duplicates(df: DataFrame, name: str, key: Sequence[str], row_id: str | None = None) -> DataFrame:
    """Extend ``bad`` by ``name`` on repeated keys.

    With ``row_id`` (a unique, ordered column) the smallest id of a key is kept and only the later
    rows are bad; without it all rows of a repeated key are. The decision is an aggregate, combined
    before the shuffle, joined back to the rows: a key with very many rows never sits in one group.
    """
    repeated = (
        df.dropna(subset=list(key))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("__n"), *([F.min(row_id).alias("__keep")] if row_id else []))
        .filter(F.col("__n") > 1)
    )
    joined = df.join(repeated, list(key), "left")
    bad = F.col("__n").isNotNull()
    if row_id:
        bad = bad & (F.col(row_id) != F.col("__keep"))
    return mark(joined, name, bad).select(*df.columns)


def flag_taken(df: DataFrame, name: str, key: Sequence[str], existing: DataFrame) -> DataFrame:
    """Extend ``bad`` by ``name`` where the key is present in an existing table."""
    taken = existing.select(*key).join(df.select(*key), list(key), "left_semi").distinct().withColumn("__t", F.lit(1))
    return mark(df.join(taken, list(key), "left"), name, F.col("__t").isNotNull()).select(*df.columns)


def flag_orphans(
    df: DataFrame, name: str, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Extend ``bad`` by ``name`` where a complete foreign key has no parent."""
    keys = [f"__f{i}" for i in range(len(columns))]
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_columns, keys)]).distinct()
    joined = df.join(parents.withColumn("__hit", F.lit(1)), [F.col(c) == F.col(k) for c, k in zip(columns, keys)], "left")
    given = ~any_true([F.col(c).isNull() for c in columns])
    return mark(joined, name, given & F.col("__hit").isNull()).select(*df.columns)


def mark(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """Extend ``bad`` by ``name`` where the condition holds."""
    more = F.when(bad, F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(BAD, F.concat(F.col(BAD), more))


def check_table(
    df: DataFrame,
    table: Table,
    parents: Mapping[str, DataFrame] | None = None,
    existing: DataFrame | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Flag every declared rule: NOT NULL, length, CHECK, keys (also against ``existing``), FKs."""
    flagged = flag_rows(df, row_rules(table))
    for name, key in ((f"{table.name}_pkey", table.key), *table.unique):
        if not key:
            continue
        flagged = flag_duplicates(flagged, name, key, row_id)
        if existing is not None:
            flagged = flag_taken(flagged, name, key, existing)
    for fk in table.foreign_keys:
        if parents and fk.parent in parents:
            flagged = flag_orphans(flagged, fk.name, fk.columns, parents[fk.parent], fk.parent_columns)
    return flagged.withColumn(BAD, F.array_distinct(BAD))


def split_rows(flagged: DataFrame) -> Split:
    """Row-level acceptance: valid rows land, the others do not."""
    clean = F.size(BAD) == 0
    return Split(flagged.filter(clean).drop(BAD), flagged.filter(~clean))


def violations(flagged: DataFrame, key: Sequence[str]) -> DataFrame:
    """(constraint_name, key..., detail), one row per broken rule and row."""
    detail = F.to_json(F.struct(*[F.col(c) for c in flagged.columns if c != BAD]))
    return flagged.filter(F.size(BAD) > 0).select(F.explode(BAD).alias("constraint_name"), *key, detail.alias("detail"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts; empty means the columns are unique."""
    return df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def validate_new_check(df: DataFrame, check: Check) -> DataFrame:
    """Existing rows that stand against adding a rule."""
    return df.filter(~F.coalesce(F.expr(check.expr), F.lit(True)))


# ---- units of work ----------------------------------------------------------------------------


def bad_units(flagged: Mapping[str, DataFrame], unit: str) -> DataFrame:
    """Units that hold at least one bad row in any of the tables."""
    union = None
    for df in flagged.values():
        ids = df.filter(F.size(BAD) > 0).select(unit)
        union = ids if union is None else union.unionByName(ids)
    return union.distinct()


def quarantine_units(flagged: Mapping[str, DataFrame], unit: str) -> dict[str, Split]:
    """All or nothing: one bad row anywhere sends every row of its unit, in all tables, aside.

    A row without a unit is a unit of its own.
    """
    # Every valid and rejected frame needs the list; written once, the tables are not checked again.
    bad = materialize(bad_units(flagged, unit), "bad-units")
    alone = F.col(unit).isNull() & (F.size(BAD) > 0)
    return {
        name: Split(
            df.filter(~alone).join(bad, unit, "left_anti").drop(BAD),
            df.join(bad, unit, "left_semi").unionByName(df.filter(alone)),
        )
        for name, df in flagged.items()
    }


def quarantine_steps(
    attempts: DataFrame, unit: str, step: str, attempt: str, ok: Column, required: Column | None = None
) -> Split:
    """Step-level acceptance: of each (unit, step) the first valid attempt stands.

    Failed attempts are set aside. Attempts with the same number are told apart by a hash of the row; of
    rows that agree in all columns one stands. A unit whose ``required`` step has no valid attempt is dropped
    with all its steps.
    """
    valid = holds(ok)
    need = holds(required) if required is not None else F.lit(False)
    order = F.struct(F.col(attempt).alias("at"), F.xxhash64(*[F.col(c) for c in attempts.columns]).alias("tie"))
    steps = attempts.groupBy(unit, step).agg(F.min(F.when(valid, order)).alias("__first"), F.max(need).alias("__need"))
    lost = steps.filter(F.col("__need") & F.col("__first").isNull()).select(unit).distinct()
    winners = steps.filter(F.col("__first").isNotNull()).drop("__need").join(lost, unit, "left_anti")
    marked = attempts.join(winners, [unit, step], "left").withColumn(
        "__kept", holds(valid & (order == F.col("__first")))
    )
    kept, aside = marked.filter("__kept").select(attempts.columns), marked.filter("NOT __kept").select(attempts.columns)
    again = kept.groupBy(unit, step).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    copies = null_safe_join(kept.dropDuplicates([unit, step]), again, [unit, step], "inner")
    copies = copies.withColumn("__k", F.explode(F.sequence(F.lit(2), F.col("__n").cast("int")))).select(attempts.columns)
    return Split(kept.dropDuplicates([unit, step]), aside.unionByName(copies))


def partial_units(rows: DataFrame, unit: str, expected: int, step: str = "step") -> DataFrame:
    """Units that are only partly present: fewer distinct steps than expected."""
    present = rows.groupBy(unit).agg(F.count_distinct(step).alias("present"))
    return present.filter(F.col("present") < expected).withColumn("expected", F.lit(expected).cast("bigint"))


# ---- references and states --------------------------------------------------------------------


def delete_blockers(doomed: DataFrame, table: Table, children: Mapping[str, DataFrame], tables: Mapping[str, Table]) -> DataFrame:
    """Rows of a delete set that foreign keys protect: (constraint_name, key...)."""
    report = None
    for name, child in children.items():
        for fk in tables[name].foreign_keys:
            if fk.parent != table.name:
                continue
            hits = blocked_parents(doomed, fk.parent_columns, child, fk.columns).select(
                F.lit(fk.name).alias("constraint_name"), *table.key
            )
            report = hits if report is None else report.unionByName(hits)
    if report is None:
        raise ValueError(f"no given child refers to {table.name}")
    return report


def illegal_transitions(
    changes: DataFrame, edges: DataFrame, statuses: DataFrame, entity: str = "entity_type",
    source: str = "from_status_id", to: str = "to_status_id",
) -> DataFrame:
    """Status changes that no edge allows or that leave a final status, with the reason."""
    allowed = edges.select(entity, source, to).distinct().withColumn("__edge", F.lit(1))
    final = statuses.filter("is_final").select(F.col("status_id").alias(source)).distinct().withColumn("__final", F.lit(1))
    marked = changes.join(allowed, [entity, source, to], "left").join(final, source, "left")
    reason = F.when(F.col("__final").isNotNull(), "from final status").when(F.col("__edge").isNull(), "no such transition")
    return marked.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(*changes.columns, "reason")


def wrong_entity_status(df: DataFrame, statuses: DataFrame, entity_type: str, column: str = "status_id") -> DataFrame:
    """Rows whose status is not declared for their kind of entity."""
    own = statuses.filter(F.col("entity_type") == entity_type).select(F.col("status_id").alias(column))
    return df.dropna(subset=[column]).join(own, column, "left_anti").select(df.columns)


def constraint_summary(spark: SparkSession, reports: Mapping[str, DataFrame]) -> DataFrame:
    """Number of violations per constraint over several violation frames."""
    union = None
    for df in reports.values():
        rows = df.select("constraint_name")
        union = rows if union is None else union.unionByName(rows)
    if union is None:
        return literal(spark, [], "constraint_name string, n_rows bigint")
    return union.groupBy("constraint_name").agg(F.count(F.lit(1)).alias("n_rows"))


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    return missing_parents(child, columns, parent, parent_columns)
