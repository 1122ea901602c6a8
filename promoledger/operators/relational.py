"""Joins, lookups, sorts and paging with the semantics the reports need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promoledger.operators.numbering import number_rows


def counted_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with ``__n``, the number of rows the key had."""
    values = [c for c in df.columns if c not in keys]
    picked = F.first(F.struct(*values)) if values else F.lit(None)
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), picked.alias("__row"))
    return grouped.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in values], "__n")


def only_one(value: Column, keys: Sequence[str], what: str) -> Column:
    """The value, or a failure of the query where ``__n`` is above one.

    As a value and not as a filter the test stays above a join, so only rows that take part in it can
    fail. It is part of the plan and costs no extra job.
    """
    message = F.concat(F.lit(f"more than one {what} for "), F.to_json(F.struct(*keys)))
    return F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(value)


def unique_rows(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """One row per key; the query fails if a key occurs twice."""
    counted = counted_rows(df, keys)
    return counted.filter(only_one(F.lit(True), keys, what)).select(df.columns)


def repeated(df: DataFrame, times: str, block: int = 4096) -> DataFrame:
    """Every row as often as its column ``times`` says, without that column.

    Rows are repeated in blocks, so no array grows with the count; a NULL or 0 gives no row.
    """
    columns = [F.col(f"`{c}`") for c in df.columns if c != times]
    blocks = df.filter(F.col(times) > 0).select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(`{times}` - 1) div {block}"))).alias("__block"))
    size = F.least(F.col(times) - F.col("__block") * block, F.lit(block)).cast("int")
    return blocks.select("*", F.explode(F.array_repeat(F.lit(True), size)).alias("__copy")).select(*columns)


def lookup(df: DataFrame, reference: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Scalar lookup: add ``take`` = {new column: reference column}; NULL when nothing matches.

    ``on`` maps columns of ``df`` to columns of ``reference``. Two matches for one row fail the query.
    """
    keys = [f"__k{i}" for i in range(len(on))]
    side = reference.select(
        *[F.col(r).alias(k) for k, r in zip(keys, on.values())], *[F.col(c).alias(n) for n, c in take.items()]
    )
    condition = [F.col(c) == F.col(k) for c, k in zip(on, keys)]
    joined = df.join(counted_rows(side, keys), condition, "left")
    return joined.withColumns({n: only_one(F.col(n), keys, "lookup row") for n in take}).select(*df.columns, *take)


def left_with_condition(left: DataFrame, right: DataFrame, on: str | Sequence[str], keep: Column) -> DataFrame:
    """Left join whose extra condition sits in ON: unmatched left rows stay."""
    return left.join(right.filter(keep), on, "left")


def missing_parents(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    """Child rows whose complete key has no parent; a NULL in the key passes."""
    keys = [f"__p{i}" for i in range(len(columns))]
    parents = parent.select(*[F.col(p).alias(k) for p, k in zip(parent_columns, keys)])
    given = child.dropna(subset=list(columns))
    return given.join(parents, [F.col(c) == F.col(k) for c, k in zip(columns, keys)], "left_anti")


def blocked_parents(doomed: DataFrame, parent_columns: Sequence[str], child: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of a delete set that some child still refers to."""
    keys = [f"__c{i}" for i in range(len(columns))]
    # Distinct keys first: a parent with a billion children shuffles as a handful of rows.
    used = child.select(*[F.col(c).alias(k) for c, k in zip(columns, keys)]).dropna().distinct()
    return doomed.join(used, [F.col(p) == F.col(k) for p, k in zip(parent_columns, keys)], "left_semi")


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order, without a full sort."""
    return df.orderBy(*order_by).limit(k)


def after_key(df: DataFrame, order: str, last, size: int) -> DataFrame:
    """Next page of a forward scan: the ``size`` rows after key ``last`` (``None`` = from the start)."""
    rows = df if last is None else df.filter(F.col(order) > F.lit(last))
    return rows.orderBy(order).limit(size)


def with_pages(df: DataFrame, order_by: Sequence[Column], size: int, skip: int = 0) -> DataFrame:
    """Add ``row_num`` and 0-based ``page``; the first ``skip`` rows are passed over."""
    rows = number_rows(df, order_by).filter(F.col("row_num") > skip)
    return rows.withColumn("page", F.floor((F.col("row_num") - 1 - skip) / size).cast("bigint"))


def write_pages(df: DataFrame, order_by: Sequence[Column], size: int, path: str) -> None:
    """Export a finished report as one directory per page."""
    pages = with_pages(df, order_by, size).hint("rebalance", "page")
    pages.sortWithinPartitions("page", "row_num").write.partitionBy("page").parquet(path)
