"""Checked loads of several tables at once, committed together."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoledger.functions.predicates import any_true
from promoledger.operators.dml import fill_defaults
from promoledger.operators.quality import check_table, mark, quarantine_units, split_rows, violations
from promoledger.session import materialize
from promoledger.sources.catalog import child_first_order
from promoledger.sources.schemas import TABLES, Col, ForeignKey, Table
from promoledger.sources.snapshots import SnapshotStore


@dataclass(frozen=True)
class Load:
    """Rejected rows and broken rules per table; the valid rows are in the store."""

    rejected: dict[str, DataFrame]
    violations: dict[str, DataFrame]
    commit_id: int


def _flag_fk(
    rows: DataFrame, fk: ForeignKey, unit: str, stored_parent: DataFrame | None, new_parent: DataFrame | None
) -> DataFrame:
    """Flag foreign keys met neither by a stored row nor by a new row of the same unit."""
    columns, keys = rows.columns, [f"__k{i}" for i in range(len(fk.columns))]
    found = []
    for name, parent, scope in (("__stored", stored_parent, []), ("__own", new_parent, [unit])):
        if parent is None:
            continue
        side = parent.select(*scope, *[F.col(p).alias(k) for p, k in zip(fk.parent_columns, keys)]).dropna()
        # Only the parents the batch mentions: a small batch is broadcast to a large parent table.
        mentioned = rows.select(*[F.col(c).alias(k) for c, k in zip(fk.columns, keys)])
        side = side.join(mentioned, keys, "left_semi").distinct().withColumnsRenamed({unit: "__unit"}).withColumn(name, F.lit(True))
        condition = [F.col(c) == F.col(k) for c, k in zip(fk.columns, keys)] + [F.col(u) == F.col("__unit") for u in scope]
        rows = rows.join(side, condition, "left").drop(*keys, "__unit")
        found.append(F.col(name).isNotNull())
    given = ~any_true([F.col(c).isNull() for c in fk.columns])
    return mark(rows, fk.name, given & ~any_true(found)).select(*columns)


def load_checked(
    store: SnapshotStore,
    batches: Mapping[str, DataFrame],
    as_of,
    actor: str,
    unit: str = "unit_id",
    mode: str = "unit",
    tables: Mapping[str, Table] = TABLES,
) -> Load:
    """Append batches to stored tables under all declared rules.

    Every batch row names the unit of work it belongs to. ``mode="unit"`` lands a unit completely or
    not at all; ``mode="row"`` lands each valid row, as single statements would, and may leave partial
    units behind. A foreign key is met by a stored row or by a row of the same unit.
    """
    if mode not in ("unit", "row"):
        raise ValueError(mode)
    pinned = store.pin()
    stored = {name: pinned.read(name) for name in pinned.versions}
    flagged: dict[str, DataFrame] = {}
    # Parents first: in row mode a rejected parent is no longer there for its children.
    for name in reversed(child_first_order(tables)):
        if name not in batches:
            continue
        table = tables[name]
        rows = fill_defaults(batches[name], _with_unit(table, batches[name], unit), as_of, actor)
        checked = check_table(rows, replace(table, foreign_keys=()), existing=stored.get(name))
        for fk in table.foreign_keys:
            new_parent = flagged.get(fk.parent)
            if new_parent is not None and mode == "row":
                new_parent = split_rows(new_parent).valid
            if fk.parent in stored or new_parent is not None:
                checked = _flag_fk(checked, fk, unit, stored.get(fk.parent), new_parent)
        # Children, quarantine and reports all read the verdicts; written once, rules run once.
        flagged[name] = materialize(checked, f"checked-{name}")
    split = quarantine_units(flagged, unit) if mode == "unit" else {n: split_rows(df) for n, df in flagged.items()}
    fresh = {name: part.valid.select(*tables[name].schema.fieldNames()) for name, part in split.items()}
    commit = store.commit(append=fresh)
    return Load({n: s.rejected for n, s in split.items()}, {n: violations(df, [unit]) for n, df in flagged.items()}, commit)


def _with_unit(table: Table, batch: DataFrame, unit: str) -> Table:
    """The table plus the unit column, so that defaults are filled around it."""
    return replace(table, columns=(Col(unit, batch.schema[unit].dataType), *table.columns))
