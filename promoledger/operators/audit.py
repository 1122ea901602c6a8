"""Change capture, history and restore."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.functions.predicates import any_true
from promoledger.functions.scalars import distinct_from
from promoledger.operators.dml import Change, update_from
from promoledger.operators.numbering import HOT_ROWS, with_previous

PROGRAM_COLUMNS = ("program_name", "budget_limit", "start_at", "end_at", "status_id")


def capture_changes(
    before: DataFrame,
    after: DataFrame,
    key: str,
    tracked: Sequence[str],
    as_of,
    actor: str,
    actor_column: str = "updated_by",
) -> DataFrame:
    """Old values of every row in which a tracked column really changed.

    Only rows present on both sides are updates; inserted and deleted rows leave no trace. NULL to
    NULL is no change, NULL to value is one.
    """
    old = before.select(key, *[F.col(c).alias(f"old_{c}") for c in tracked])
    who = F.col(actor_column) if actor_column in after.columns else F.lit(None).cast("string")
    new = after.select(key, *tracked, who.alias("__who"))
    changed = any_true([distinct_from(F.col(f"old_{c}"), F.col(c)) for c in tracked])
    return old.join(new, key).filter(changed).select(
        key,
        *[f"old_{c}" for c in tracked],
        F.lit(str(as_of)).cast("timestamp_ntz").alias("changed_at"),
        F.coalesce("__who", F.lit(actor)).alias("changed_by"),
        F.lit("UPDATE").alias("change_type"),
    )


def capture_from_images(
    images: DataFrame,
    key: str,
    tracked: Sequence[str],
    order_by: Sequence[Column],
    changed_at: str,
    changed_by: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """History rows from a log of after-images: each image against the previous one of its key."""
    linked = with_previous(images, [key], order_by, {f"old_{c}": c for c in tracked}, hot_rows)
    changed = any_true([distinct_from(F.col(f"old_{c}"), F.col(c)) for c in tracked])
    return linked.filter(~F.col("is_first") & changed).select(
        key,
        *[f"old_{c}" for c in tracked],
        F.col(changed_at).alias("changed_at"),
        F.col(changed_by).alias("changed_by"),
        F.lit("UPDATE").alias("change_type"),
    )


def history_of(history: DataFrame, key: str, value) -> DataFrame:
    """History of one row, newest first."""
    return history.filter(F.col(key) == F.lit(value)).orderBy(F.col("changed_at").desc(), F.col("history_id").desc())


def latest_history(history: DataFrame, key: str, id_column: str = "history_id") -> DataFrame:
    """The newest history row of each key, by an aggregate instead of a window."""
    values = [c for c in history.columns if c != key]
    newest = history.groupBy(key).agg(F.max_by(F.struct(*values), id_column).alias("__h"))
    return newest.select(key, *[F.col(f"__h.{c}").alias(c) for c in values])


def restore(
    current: DataFrame,
    history: DataFrame,
    key: str,
    columns: Sequence[str],
    as_of,
    actor: str,
    id_column: str = "history_id",
) -> Change:
    """Put the latest old values back. The restore is itself an update and can be captured again."""
    stamp = {}
    if "updated_at" in current.columns:
        stamp["updated_at"] = F.lit(str(as_of)).cast("timestamp_ntz")
    if "updated_by" in current.columns:
        stamp["updated_by"] = F.lit(actor)
    source = latest_history(history, key, id_column)
    return update_from(current, source, [key], {c: f"old_{c}" for c in columns}, stamp)
