"""Deletes along foreign keys: what must go with a set of rows, and in which order."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.session import materialize
from promoledger.sources.catalog import child_first_order
from promoledger.sources.folders import finish_replacement, replace_folder
from promoledger.sources.schemas import Table


def doomed_rows(
    roots: Mapping[str, DataFrame], frames: Mapping[str, DataFrame], tables: Mapping[str, Table]
) -> dict[str, DataFrame]:
    """Per table the keys of all rows that have to go with ``roots``, children before their parents.

    A frontier of newly doomed rows moves along the foreign keys, one semi join per key and round, until
    no row is added; a table that refers to itself takes one round per generation. Rows with a NULL in
    their foreign key refer to nothing. Every round is a written table of keys, so the result can be
    used after ``frames`` change. Tables without a doomed row are left out; a cycle of different tables
    has no delete order and is refused. Row keys must not be NULL.
    """
    order = [t for t in child_first_order(tables) if t in frames]
    # Besides its key a doomed row carries the columns by which children refer to it.
    carried = {t: list(tables[t].key) for t in order}
    links = [(child, fk) for child in order for fk in tables[child].foreign_keys if fk.parent in carried]
    for _, fk in links:
        carried[fk.parent] += [c for c in fk.parent_columns if c not in carried[fk.parent]]
    doomed: dict[str, list[DataFrame]] = {}
    found = {t: [root.select(*tables[t].key)] for t, root in roots.items()}
    while found:
        frontier = {}
        for name, parts in found.items():
            key = list(tables[name].key)
            keys = reduce(DataFrame.unionByName, parts).distinct()
            # Whole rows again: the carried columns come from the stored table, absent keys go.
            rows = frames[name].select(*carried[name]).join(keys, key, "left_semi")
            for earlier in doomed.get(name, []):
                rows = rows.join(earlier.select(*key), key, "left_anti")
            rows = materialize(rows, f"doomed-{name}")
            if not rows.isEmpty():
                frontier[name] = rows
                doomed.setdefault(name, []).append(rows)
        found = {}
        for child, fk in links:
            if fk.parent in frontier:
                hit = frontier[fk.parent].select(*[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns, strict=True)])
                rows = frames[child].join(hit, list(fk.columns), "left_semi")
                found.setdefault(child, []).append(rows.select(*tables[child].key))
    return {t: reduce(DataFrame.unionByName, doomed[t]).select(*tables[t].key) for t in order if t in doomed}


def delete_stored(spark: SparkSession, doomed: Mapping[str, DataFrame], paths: Mapping[str, str]) -> None:
    """Delete doomed rows from stored Parquet tables in the order of ``doomed``, as ``doomed_rows`` gives it.

    Children go first, so at no time does a stored row refer to a deleted one, also if the job ends
    half-way; running it again with the same keys finishes it. Tables that lose no row keep their files.
    """
    for name, keys in doomed.items():
        finish_replacement(spark, paths[name])
        stored = spark.read.parquet(paths[name])
        replace_folder(stored.join(keys, keys.columns, "left_anti").select(stored.columns), paths[name])
