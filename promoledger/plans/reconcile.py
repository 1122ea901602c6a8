"""Jobs that read, decide and write: monthly payout reconciliation and audited updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.functions.predicates import any_of, any_true, holds, live, month_bounds, half_open
from promoledger.functions.scalars import MONEY, distinct_from
from promoledger.operators.audit import PROGRAM_COLUMNS
from promoledger.operators.dml import next_ids, update_where
from promoledger.operators.quality import BAD, flag_rows, row_rules, violations
from promoledger.session import materialize
from promoledger.sources.folders import finish_addition, numbered_folders, replace_and_add
from promoledger.sources.schemas import TABLES
from promoledger.sources.snapshots import SnapshotStore
from promoledger.sources.literal import literal

# Stored value, fixed by the given schema.
RECONCILED_BY = "SYSTEM_PROCEDURE"


@dataclass(frozen=True)
class Reconciliation:
    """``marked``: all given clicks, the eligible ones marked; ``report``: payout per partner; ``errors``: requested partners that do not exist or have no rate."""

    marked: DataFrame
    report: DataFrame
    errors: DataFrame


def reconcile_month(
    clicks: DataFrame,
    partners: DataFrame,
    rules: DataFrame,
    year: int,
    month: int,
    as_of,
    partner_ids: Sequence[int] | None = None,
    status_id: int = 1,
) -> Reconciliation:
    """Close a month for all (or the given) partners at once.

    Eligible are clicks of the month and of the requested partners that are neither suspicious nor
    reconciled; no other click changes and none is left out. The same condition marks and counts, so a
    second run over ``marked`` pays nothing. Clicks are counted per partner
    before the rates are joined.
    """
    rated = live(any_of(partners, "partner_id", partner_ids)).join(
        rules.select("commission_rule_id", "payout_rate"), "commission_rule_id"
    )
    # Read by the report, the marks and the errors. Written, its size is known, so a partner table
    # that fits is broadcast to the clicks instead of both being shuffled.
    rated = materialize(rated.select("partner_id", "partner_name", "payout_rate"), "rated")
    start, end = month_bounds(year, month)
    in_month = half_open("clicked_at", start, end)
    month_clicks = any_of(clicks.filter(in_month), "partner_id", partner_ids)
    eligible = ~F.col("is_suspicious") & F.col("reconciliation_status_id").isNull()
    counts = month_clicks.filter(eligible).groupBy("partner_id").agg(F.count(F.lit(1)).alias("__n"))
    valid = F.coalesce("__n", F.lit(0)).cast("bigint")
    report = rated.join(counts, "partner_id", "left").select(
        "partner_id",
        "partner_name",
        valid.alias("valid_clicks"),
        "payout_rate",
        (valid.cast("decimal(20,0)") * F.col("payout_rate")).cast(MONEY).alias("total_payout"),
    )

    # ``rated`` holds the requested partners only.
    flagged = clicks.join(rated.select("partner_id").withColumn("__rated", F.lit(True)), "partner_id", "left")
    marked = update_where(
        flagged.select(*clicks.columns, "__rated"),
        eligible & in_month & F.col("__rated"),
        {
            "reconciliation_status_id": status_id,
            **({"reconciled_at": F.lit(str(as_of)).cast("timestamp_ntz")} if "reconciled_at" in clicks.columns else {}),
            **({"reconciled_by": RECONCILED_BY} if "reconciled_by" in clicks.columns else {}),
        },
    ).table.drop("__rated")

    spark = clicks.sparkSession
    if partner_ids is None:
        requested = month_clicks.select("partner_id").distinct()
    else:
        requested = literal(spark, [(int(p),) for p in partner_ids], "partner_id bigint")
    errors = requested.join(rated.select("partner_id"), "partner_id", "left_anti").withColumn(
        "error", F.concat(F.lit("no live, rated partner "), F.col("partner_id"))
    )
    return Reconciliation(marked, report, errors)


def run_reconciliation(
    clicks_path: str,
    payouts_path: str,
    partners: DataFrame,
    rules: DataFrame,
    year: int,
    month: int,
    as_of,
    partner_ids: Sequence[int] | None = None,
    status_id: int = 1,
) -> DataFrame:
    """The job over plain Parquet folders: mark the month's clicks, add the payouts of this run; all payouts of the period.

    Clicks lie in ``month=yyyy-MM`` folders (``layout.write_partitioned``), so closing a month reads and
    rewrites that month only. Payouts lie below ``period=yyyy-MM/run_no=n``, one row per partner and
    run; a run adds a folder and no earlier one changes. Marks and payouts appear together
    (``folders.replace_and_add``): after a crash the next run, for whichever partners, first completes or
    drops the one cut short, so no click is paid twice or left out. A partner that was paid gets a
    further row only for clicks that came in since; a run without any such row writes nothing. A month
    without a folder fails the run.
    """
    spark = partners.sparkSession
    period = f"{year:04d}-{month:02d}"
    clicks_folder, runs = f"{clicks_path.rstrip('/')}/month={period}", f"{payouts_path.rstrip('/')}/period={period}"
    done = numbered_folders(spark, runs, "run_no")
    run = done[-1] + 1 if done else 1
    added = f"{runs}/run_no={run}"
    finish_addition(spark, clicks_folder, added)
    if numbered_folders(spark, runs, "run_no") != done:
        # A run cut short has just been completed under this number.
        return run_reconciliation(clicks_path, payouts_path, partners, rules, year, month, as_of, partner_ids, status_id)
    result = reconcile_month(spark.read.parquet(clicks_folder), partners, rules, year, month, as_of, partner_ids, status_id)
    report = materialize(result.report, "payouts")
    schema = T.StructType([*report.schema.fields, T.StructField("period", T.StringType()), T.StructField("run_no", T.IntegerType())])
    stored = spark.read.schema(schema).option("basePath", payouts_path)
    if done:
        paid = stored.parquet(runs).select("partner_id").distinct()
        first = report.filter("valid_clicks = 0").join(paid, "partner_id", "left_anti")
        report = report.filter("valid_clicks > 0").unionByName(first)
    if not report.isEmpty():
        replace_and_add(result.marked, clicks_folder, report, added)
        done = [*done, run]
    return stored.parquet(runs) if done else literal(spark, [], schema)


@dataclass(frozen=True)
class AuditedUpdate:
    """New table, new history rows and the broken rules."""

    table: DataFrame
    captured: DataFrame
    violations: DataFrame


def audited_update(
    programs: DataFrame,
    history: DataFrame,
    condition: Column,
    assignments: Mapping[str, object],
    as_of,
    actor: str,
    tracked: Sequence[str] = PROGRAM_COLUMNS,
    key: str = "program_id",
    table: str = "promotion_program",
) -> AuditedUpdate:
    """Guarded update with time stamp, row rules and history, in the order a database runs them.

    Rows that would break a rule keep their old values and are listed in ``violations``. The table is read
    once: old and new values stand side by side in a row, which gives its table, history and violation
    rows; they are written in one folder each. No join, so repeated or NULL keys make no difference.
    """
    stamped = {**assignments, "updated_at": F.lit(str(as_of)).cast("timestamp_ntz")}
    if "updated_by" not in assignments:
        stamped["updated_by"] = actor
    hit = holds(condition)
    pairs = programs.withColumns({"__old": F.struct(*programs.columns), "__hit": hit})
    tried = flag_rows(update_where(pairs, F.col("__hit"), stamped).table, row_rules(TABLES[table]))
    refused = F.col("__hit") & (F.size(BAD) > 0)
    new, old = F.struct(*programs.columns), F.col("__old")
    differs = any_true([distinct_from(old[c], F.col(c)) for c in tracked])
    entry = F.struct(
        F.col(key),
        *[old[c].alias(f"old_{c}") for c in tracked],
        F.lit(str(as_of)).cast("timestamp_ntz").alias("changed_at"),
        F.coalesce("updated_by", F.lit(actor)).alias("changed_by"),
        F.lit("UPDATE").alias("change_type"),
    )

    def tagged(tag: str, row: Column | None = None, entry_: Column | None = None, bad: Column | None = None) -> Column:
        parts = ((row, new, "row"), (entry_, entry, "entry"), (bad, F.col(BAD), BAD))
        # ``when`` without a branch that holds gives NULL of the right type.
        values = [F.when(F.lit(given is not None), given if given is not None else like).alias(name) for given, like, name in parts]
        return F.struct(F.lit(tag).alias("tag"), *values)

    out = F.array_compact(F.array(
        tagged("table", F.when(refused, old).otherwise(new)),
        F.when(F.col("__hit") & ~refused & differs, tagged("history", entry_=entry)),
        F.when(refused, tagged("violation", new, bad=F.col(BAD))),
    ))
    written = materialize(tried.select(F.inline(out)), "audited", partition_by="tag")
    new_table = written.filter("tag = 'table'").select("row.*")
    captured = written.filter("tag = 'history'").select("entry.*")
    bad = violations(written.filter("tag = 'violation'").select("row.*", BAD), [key])
    numbered = next_ids(captured, history, "history_id", [F.col("changed_at"), F.col(key)])
    return AuditedUpdate(new_table, numbered.select(history.columns), bad)


def run_audited_update(
    store: SnapshotStore, condition: Column, assignments: Mapping[str, object], as_of, actor: str
) -> None:
    """Audited update of the stored programs: table and history become visible in one commit."""
    pinned = store.pin()
    result = audited_update(
        pinned.read("promotion_program"), pinned.read("promotion_program_history"), condition, assignments, as_of, actor
    )
    if not result.violations.isEmpty():
        raise ValueError(f"update breaks rules: {[r.constraint_name for r in result.violations.limit(5).collect()]}")
    store.commit({"promotion_program": result.table}, append={"promotion_program_history": result.captured})
