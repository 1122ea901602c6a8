"""The registry as DataFrames, and bootstrap of catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from promoledger.sources.schemas import TABLES, Table
from promoledger.sources.literal import literal


def has_column(df: DataFrame, name: str) -> bool:
    """Does the frame have this column, ignoring case?"""
    return name.lower() in {f.lower() for f in df.schema.fieldNames()}


def columns_frame(spark: SparkSession, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, column_name) of the given frames, or of the registry."""
    if frames is None:
        rows = [(t.name, c.name) for t in TABLES.values() for c in t.columns]
    else:
        rows = [(name, column) for name, df in frames.items() for column in df.columns]
    return literal(spark, rows, "table_name string, column_name string")


def constraints_frame(spark: SparkSession, tables: Iterable[Table] | None = None) -> DataFrame:
    """Declared rules, one row each: (table_name, constraint_name, kind, definition).

    Kinds: p primary key, u unique, c check, f foreign key, n not null.
    """
    rows: list[tuple[str, str, str, str]] = []
    for t in tables if tables is not None else TABLES.values():
        if t.key:
            rows.append((t.name, f"{t.name}_pkey", "p", ", ".join(t.key)))
        rows += [(t.name, name, "u", ", ".join(columns)) for name, columns in t.unique]
        rows += [(t.name, c.name, "c", c.expr) for c in t.checks]
        rows += [
            (t.name, k.name, "f", f"{', '.join(k.columns)} -> {k.parent}({', '.join(k.parent_columns)})")
            for k in t.foreign_keys
        ]
        rows += [(t.name, f"{t.name}_{c.name}_not_null", "n", c.name) for c in t.columns if c.required]
    return literal(spark, rows, "table_name string, constraint_name string, kind string, definition string")


def create_tables(spark: SparkSession, database: str, tables: Iterable[Table], rebuild: bool = False) -> None:
    """Create database and Parquet tables that are absent; ``rebuild`` drops the database first."""
    if rebuild:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for t in tables:
        columns = ", ".join(f"`{c.name}` {c.type.simpleString()}" for c in t.columns)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.`{t.name}` ({columns}) USING parquet")


def child_first_order(tables: Mapping[str, Table] | None = None) -> list[str]:
    """Table names such that every child comes before its parents (safe order for deletes)."""
    remaining = dict(tables or TABLES)
    order: list[str] = []
    while remaining:
        parents = {k.parent for t in remaining.values() for k in t.foreign_keys if k.parent != t.name}
        free = [name for name in remaining if name not in parents]
        if not free:
            raise ValueError(f"foreign keys form a cycle: {sorted(remaining)}")
        order += free
        for name in free:
            del remaining[name]
    return order
