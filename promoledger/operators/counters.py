"""Contended counters as set operations: no locks, the same outcome every time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promoledger.functions.joins import null_safe_join
from promoledger.operators.numbering import HOT_ROWS, rank_within
from promoledger.operators.relational import repeated, unique_rows
from promoledger.operators.selection import CELL_ROWS, has_digits, last_covered
from promoledger.session import materialize


def allocate_capped(
    claims: DataFrame,
    quotas: DataFrame,
    key: str,
    order_by: Sequence[Column],
    limit: str = "issuance_limit",
    issued: str = "total_issued",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Grant claims in arrival order until each counter reaches its limit.

    Adds ``claim_no`` (arrival order within the key) and ``granted``. ``order_by`` must be a total
    order. Claims on an unknown key are refused. One key may hold most claims: see ``numbering``.
    """
    ranked = rank_within(claims, [key], order_by, "claim_no", hot_rows)
    free = unique_rows(quotas.select(key, (F.col(limit) - F.col(issued)).cast("bigint").alias("__free")), [key], "quota")
    granted = F.coalesce(F.col("claim_no") <= F.col("__free"), F.lit(False))
    return ranked.join(free, key, "left").withColumn("granted", granted).drop("__free")


def grant_claims(
    claims: DataFrame,
    quotas: DataFrame,
    key: str,
    order_by: Sequence[str],
    limit: str = "issuance_limit",
    issued: str = "total_issued",
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``allocate_capped`` without the claim numbers: adds ``granted`` alone.

    Whether a claim is in time only needs the last claim each quota still covers, which
    ``selection.last_covered`` finds by counting; the claims are then compared with that one row per key
    and neither sorted nor moved. The path is the same for every quota size. ``order_by`` names
    ascending columns; claims that tie on them are ordered by a hash of the row, and of claims that
    agree in every column as many are granted as the quota has room for. Two quota rows for one key fail
    the query. Order columns of a type without digits (``selection.has_digits``: floats, wide decimals,
    nested types) are numbered instead.
    """
    if not all(has_digits(claims.schema[c].dataType) for c in order_by):
        order = [*[F.col(c).asc() for c in order_by], F.xxhash64(*[F.col(c) for c in claims.columns])]
        return allocate_capped(claims, quotas, key, order, limit, issued).drop("claim_no")
    free = unique_rows(quotas.select(key, (F.col(limit) - F.col(issued)).cast("bigint").alias("__free")), [key], "quota")
    # Read by the cut and by the comparison: checked once.
    free = materialize(free, "quotas")
    tie = F.xxhash64(*[F.col(c) for c in claims.columns]).alias("__tie")
    place = [*order_by, "__tie"]
    last = last_covered(claims.select(key, *order_by, tie), free, key, place, "__free", cell_rows)
    # One row per quota; written, Spark sees its size and need not shuffle the claims to it.
    cuts = materialize(free.join(last, key, "left"), "cutoffs")
    compared = claims.join(cuts, key, "left").withColumn("__at", F.struct(*order_by, tie))
    in_time = F.col("last").isNull() | (F.col("__at") <= F.col("last"))
    decided = compared.withColumn("granted", F.coalesce((F.col("__free") > 0) & in_time, F.lit(False)))
    if cuts.filter("room < equal").isEmpty():
        return decided.select(*claims.columns, "granted")
    # Rows equal to the last one, not all of them covered: counted, then written out as often as they occurred.
    at_cut = F.coalesce((F.col("__at") == F.col("last")) & (F.col("room") < F.col("equal")), F.lit(False))
    alike = decided.filter(at_cut).groupBy(*claims.columns, "room").agg(F.count(F.lit(1)).alias("__n"))
    # One row per different text of a hash: more than one only where hashes collide.
    earlier = Window.partitionBy(key).orderBy(*[c for c in claims.columns if c != key]).rowsBetween(Window.unboundedPreceding, -1)
    given = F.least(F.greatest(F.col("room") - F.coalesce(F.sum("__n").over(earlier), F.lit(0)), F.lit(0)), F.col("__n"))
    counted = alike.withColumn("__given", given)
    parts = [
        repeated(counted.withColumn("__times", times).select(*claims.columns, "__times"), "__times").withColumn("granted", F.lit(granted))
        for times, granted in ((F.col("__given"), True), (F.col("__n") - F.col("__given"), False))
    ]
    return decided.filter(~at_cut).select(*claims.columns, "granted").unionByName(parts[0]).unionByName(parts[1])


def advance_counters(quotas: DataFrame, allocated: DataFrame, key: str, issued: str = "total_issued") -> DataFrame:
    """The counters after an allocation."""
    given = allocated.filter("granted").groupBy(key).agg(F.count(F.lit(1)).alias("__given"))
    kind = quotas.schema[issued].dataType
    total = (F.col(issued) + F.coalesce(F.col("__given"), F.lit(0))).cast(kind)
    return quotas.join(given, key, "left").withColumn(issued, total).select(quotas.columns)


def apply_increments(target: DataFrame, deltas: DataFrame, key: str, value: str, delta: str) -> DataFrame:
    """Add all deltas to their counters. Sums are combined before the shuffle and order never matters."""
    kind = target.schema[value].dataType
    sums = deltas.groupBy(key).agg(F.sum(delta).alias("__delta"))
    total = F.when(F.col("__delta").isNull(), F.col(value)).otherwise(F.col(value) + F.col("__delta"))
    return target.join(sums, key, "left").withColumn(value, total.cast(kind)).select(target.columns)


def first_commit_wins(writes: DataFrame, key: Sequence[str], base_version: str, commit_seq: str) -> DataFrame:
    """Of the writes computed from one version of a row the first commit stands; the rest conflict.

    ``commit_seq`` must be unique per key. The winner comes from a minimum per group, so a hot row
    costs no window.
    """
    group = [*key, base_version]
    winners = writes.groupBy(*group).agg(F.min(commit_seq).alias("__first"))
    outcome = F.when(F.col(commit_seq) == F.col("__first"), F.lit("applied")).otherwise(F.lit("conflict"))
    return null_safe_join(writes, winners, group, "left").select(*writes.columns, outcome.alias("outcome"))


def last_write_wins(writes: DataFrame, key: Sequence[str], value: str, commit_seq: str) -> DataFrame:
    """What blind absolute writes leave behind: the value of the latest commit per key."""
    return writes.groupBy(*key).agg(F.max_by(value, commit_seq).alias(value))


def lost_updates(target: DataFrame, deltas: DataFrame, key: str, value: str, delta: str, commit_seq: str) -> DataFrame:
    """Per counter: the right total, what read-modify-write from one stale read leaves, the loss.

    Every writer reads the starting value and stores ``value + delta``; the last commit survives.
    """
    per_key = deltas.groupBy(key).agg(F.sum(delta).alias("__sum"), F.max_by(delta, commit_seq).alias("__last"))
    kind = target.schema[value].dataType
    zero = F.lit(0).cast(kind)
    atomic = (F.col(value) + F.coalesce(F.col("__sum"), zero)).cast(kind)
    stale = (F.col(value) + F.coalesce(F.col("__last"), zero)).cast(kind)
    return target.join(per_key, key, "left").select(
        key, atomic.alias("atomic_value"), stale.alias("stale_value"), (atomic - stale).cast(kind).alias("lost_delta")
    )
