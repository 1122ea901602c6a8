"""Writes as functions from frames to frames.

Each returns a ``Change``: ``table`` is the new content, ``changed`` the rows the write touched (as
they are after it; for deletes, as they were). Storing ``changed`` alone is enough for append-only
tables; see ``sources.snapshots`` for the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.functions.predicates import any_true, holds
from promoledger.operators.numbering import first_per_key, number_rows
from promoledger.operators.relational import counted_rows, only_one, unique_rows
from promoledger.sources.schemas import ACTOR, AS_OF, NEXT_ID, Table


@dataclass(frozen=True)
class Change:
    table: DataFrame
    changed: DataFrame


class DuplicateKeyError(ValueError):
    """A plain insert met an existing key."""


def _columns(assignments: Mapping[str, object]) -> dict[str, Column]:
    return {name: v if isinstance(v, Column) else F.lit(v) for name, v in assignments.items()}


def fill_defaults(rows: DataFrame, table: Table, as_of, actor: str) -> DataFrame:
    """Add the columns a batch leaves out. Present columns stay as they are, NULLs included."""
    unknown = [c for c in rows.columns if c not in table.schema.fieldNames()]
    if unknown:
        raise ValueError(f"{table.name} has no column {unknown}")
    special = {AS_OF: F.lit(str(as_of)).cast("timestamp_ntz"), ACTOR: F.lit(actor), NEXT_ID: F.lit(None)}
    present = set(rows.columns)
    out = []
    for c in table.columns:
        if c.name in present:
            value = F.col(c.name)
        elif isinstance(c.default, str) and c.default in special:
            value = special[c.default]
        else:
            value = F.lit(c.default)
        out.append(value.cast(c.type).alias(c.name))
    return rows.select(*out)


def next_ids(batch: DataFrame, target: DataFrame, id_column: str, order_by: Sequence[Column]) -> DataFrame:
    """Number a batch from ``max(id) + 1`` of the target, in the given total order."""
    top = target.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint")).scalar()
    numbered = number_rows(batch.drop(id_column), order_by, id_column, start=top)
    return numbered.select(id_column, *[c for c in batch.columns if c != id_column])


def chain_keys(children: DataFrame, parents: DataFrame, natural_key: Sequence[str], id_column: str) -> DataFrame:
    """Give child rows the id their parent has just received, matching on the natural key."""
    ids = unique_rows(parents.select(*natural_key, id_column), list(natural_key), "parent")
    return children.join(ids, list(natural_key), "inner").drop(*[k for k in natural_key if k not in children.columns])


def append(target: DataFrame, rows: DataFrame, table: Table, as_of, actor: str) -> Change:
    filled = fill_defaults(rows, table, as_of, actor)
    return Change(target.unionByName(filled), filled)


def update_where(
    df: DataFrame, condition: Column, assignments: Mapping[str, object], stamp: Mapping[str, object] | None = None
) -> Change:
    """Guarded update. ``stamp`` columns are set on every matched row, changed or not."""
    new = _columns({**assignments, **(stamp or {})})
    hit = holds(condition)
    types = {f.name: f.dataType for f in df.schema.fields}
    after = [new[c].cast(types[c]).alias(c) if c in new else F.col(c) for c in df.columns]
    table = df.select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in new else F.col(c) for c in df.columns]
    )
    return Change(table, df.filter(hit).select(*after))


def delete_where(df: DataFrame, condition: Column) -> Change:
    hit = holds(condition)
    return Change(df.filter(~hit), df.filter(hit))


def _existing(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of the target that the batch mentions. Only key columns of the target are read, and a
    small batch is broadcast to it, so a daily feed never shuffles the whole event log."""
    return target.select(*key).join(incoming.select(*key), list(key), "left_semi")


def insert_ignore(
    target: DataFrame, incoming: DataFrame, key: Sequence[str], order_by: Sequence[Column] | None = None
) -> Change:
    """Insert rows whose key is new; existing keys and later copies in the batch are passed over.

    Of the copies in a batch the first by ``order_by`` counts, without it the smallest row, so that a
    repeated run picks the same one. A NULL in the key never collides.
    """
    keyed, nulls = _split_null_keys(incoming, key)
    rest = [F.col(c).asc() for c in incoming.columns if c not in key]
    once = first_per_key(keyed, key, order_by or rest) if order_by or rest else keyed.distinct()
    fresh = once.join(_existing(target, keyed, key), list(key), "left_anti").select(target.columns)
    fresh = fresh.unionByName(nulls.select(target.columns))
    return Change(target.unionByName(fresh), fresh)


def _split_null_keys(df: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    return df.dropna(subset=list(key)), df.filter(any_true([F.col(k).isNull() for k in key]))


def insert_strict(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> Change:
    """Insert that fails as a whole when a key exists already or occurs twice in the batch."""
    clashes = insert_conflicts(target, incoming, key).limit(5).collect()
    if clashes:
        raise DuplicateKeyError(f"duplicate key {tuple(key)}: {[tuple(r) for r in clashes]}")
    return Change(target.unionByName(incoming.select(target.columns)), incoming)


def insert_conflicts(target: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys that make ``insert_strict`` fail."""
    twice = incoming.dropna(subset=list(key)).groupBy(*key).count().filter("count > 1").select(*key)
    return _existing(target, incoming, key).unionByName(twice).distinct()


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    update: Sequence[str] | Mapping[str, object],
    order_by: Sequence[Column] | None = None,
    stamp: Mapping[str, object] | None = None,
) -> Change:
    """Insert new keys; on a known key set only the ``update`` columns (plus ``stamp``).

    ``update`` lists columns taken from the incoming row, or maps columns to fixed values. Copies of
    a key in one batch need ``order_by`` (the first row wins); without it they fail the query.
    """
    keyed, nulls = _split_null_keys(incoming, key)
    once = first_per_key(keyed, key, order_by) if order_by else unique_rows(keyed, list(key), "incoming row")
    renamed = once.select(*key, *[F.col(c).alias(f"__new_{c}") for c in once.columns if c not in key]).withColumn(
        "__hit", F.lit(True)
    )
    if isinstance(update, Mapping):
        new = _columns(update)
    else:
        new = {c: F.col(f"__new_{c}") for c in update}
    new.update(_columns(stamp or {}))
    updated = _apply(target, target.join(renamed, list(key), "left"), new)
    types = {f.name: f.dataType for f in target.schema.fields}
    absent = once.join(_existing(target, keyed, key), list(key), "left_anti").unionByName(nulls)
    inserted = absent.select(
        *[(F.col(c) if c in once.columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns]
    )
    return Change(updated.table.unionByName(inserted), updated.changed.unionByName(inserted))


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    assignments: Mapping[str, str],
    stamp: Mapping[str, object] | None = None,
) -> Change:
    """Set target columns from the matching source row: ``{target column: source column}``.

    Two source rows for one target row fail the query.
    """
    side = source.select(*on, *[F.col(s).alias(f"__new_{t}") for t, s in assignments.items()])
    side = counted_rows(side, list(on)).withColumn("__hit", F.lit(True))
    new = {t: only_one(F.col(f"__new_{t}"), on, "source row") for t in assignments}
    new.update(_columns(stamp or {}))
    return _apply(target, target.join(side, list(on), "left"), new)


def update_where_in(
    target: DataFrame,
    keys: DataFrame,
    on: Sequence[str],
    assignments: Mapping[str, object],
    condition: Column | None = None,
) -> Change:
    """Update the rows whose key occurs in ``keys`` (and that meet ``condition``)."""
    hits = keys.select(*on).distinct().withColumn("__hit", F.lit(True))
    joined = target.join(hits, list(on), "left")
    if condition is not None:
        joined = joined.withColumn("__hit", F.when(holds(condition), F.col("__hit")))
    return _apply(target, joined, _columns(assignments))


def _apply(target: DataFrame, joined: DataFrame, new: Mapping[str, Column]) -> Change:
    hit = F.col("__hit").isNotNull()
    types = {f.name: f.dataType for f in target.schema.fields}
    table = joined.select(
        *[F.when(hit, new[c]).otherwise(F.col(c)).cast(types[c]).alias(c) if c in new else F.col(c) for c in target.columns]
    )
    changed = joined.filter(hit).select(
        *[new[c].cast(types[c]).alias(c) if c in new else F.col(c) for c in target.columns]
    )
    return Change(table, changed)


def retain_since(df: DataFrame, column: str, as_of, years: int = 0, months: int = 0, days: int = 0) -> Change:
    """Drop rows older than the given age at ``as_of``."""
    cutoff = F.lit(str(as_of)).cast("timestamp_ntz") - F.make_interval(
        years=F.lit(years), months=F.lit(months), days=F.lit(days)
    )
    return delete_where(df, F.col(column) < cutoff)
