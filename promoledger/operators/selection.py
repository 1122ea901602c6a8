"""Per-key order statistics: where the first n rows of every key end, found without numbering rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promoledger.session import materialize

# Up to 2 ** BIN_BITS bins a key and round; a cell of at most CELL_ROWS rows is sorted as one array.
BIN_BITS = 10
CELL_ROWS = 1024
_LOWEST = -(2**63)
_STRING_BYTES = 6


def has_digits(kind: T.DataType) -> bool:
    """Whether ``_digits`` can lay the type's order out in whole numbers."""
    if isinstance(kind, T.DecimalType):
        return kind.precision <= 18
    if isinstance(kind, T.StringType):
        return kind == T.StringType()
    return isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType))


def _digits(column: str, kind: T.DataType, longest: int) -> list[Column]:
    """Whole numbers whose order, compared one after the other, is that of the column, NULL first."""
    c = F.col(column)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = c.cast("binary")
        parts = [
            F.conv(F.rpad(F.hex(F.substring(raw, at + 1, _STRING_BYTES)), 2 * _STRING_BYTES, "0"), 16, 10).cast("bigint")
            for at in range(0, longest, _STRING_BYTES)
        ]
        return [F.coalesce(p, F.lit(-1)) for p in [*parts, F.octet_length(c).cast("bigint")]]
    if isinstance(kind, T.DateType):
        whole = F.unix_date(c).cast("bigint")
    elif isinstance(kind, T.TimestampType):
        whole = F.unix_micros(c)
    elif isinstance(kind, T.TimestampNTZType):
        # Not through the session's time zone, whose clock changes would break the order.
        seconds = F.unix_date(c.cast("date")).cast("bigint") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
        whole = seconds * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    elif isinstance(kind, T.DecimalType):
        whole = (c * F.lit(10**kind.scale)).cast("bigint")
    else:
        whole = c.cast("bigint")
    placed = F.coalesce(whole, F.lit(_LOWEST))
    # Only a bigint can hold the lowest number itself.
    return [placed, c.isNotNull().cast("bigint")] if isinstance(kind, T.LongType) else [placed]




def _untested() -> list[Column]:
    return [F.lit(None).cast(kind).alias(name) for name, kind in (("__tested", "int"), ("__from", "bigint"), ("__to", "bigint"))]


def _narrowed(open_rows: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """The cells cut down to the bin that holds the wanted row."""
    value, following = F.get("__d", "__digit"), F.get("__d", F.col("__digit") + 1)
    width = F.col("__high").cast("double") - F.col("__low").cast("double") + 1
    shift = F.greatest(F.ceil(F.log2(width)).cast("int") - BIN_BITS, F.lit(0))
    joined = open_rows.join(cells.select(key, "__need", "__digit", shift.alias("__shift")), key)
    shown = joined.select(key, "__need", "__digit", "__shift", value.alias("__value"), following.alias("__next"))
    bins = shown.groupBy(key, "__need", "__digit", F.expr("shiftright(__value, __shift)").alias("__bin")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__value").alias("__from"), F.max("__value").alias("__to"),
        F.min("__next").alias("__next_low"), F.max("__next").alias("__next_high"),
    )
    # Over the bins of a key, not over its rows.
    upto = Window.partitionBy(key).orderBy("__bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = bins.withColumn("__upto", F.sum("__n").over(upto)).withColumn("__before", F.col("__upto") - F.col("__n"))
    chosen = held.filter((F.col("__before") < F.col("__need")) & (F.col("__need") <= F.col("__upto")))
    settled = F.col("__from") == F.col("__to")
    return chosen.select(
        key, (F.col("__need") - F.col("__before")).alias("__need"), "__n",
        (F.col("__digit") + settled.cast("int")).alias("__digit"),
        F.when(settled, F.col("__next_low")).otherwise(F.col("__from")).alias("__low"),
        F.when(settled, F.col("__next_high")).otherwise(F.col("__to")).alias("__high"),
        F.col("__digit").alias("__tested"), "__from", "__to",
    )


def last_covered(
    rows: DataFrame, wanted: DataFrame, key: str, order_by: Sequence[str], count: str, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """Per key of ``wanted`` with more rows than ``count`` asks for (and ``count`` above 0): the last row covered.

    Columns: the key; ``last``, the struct of ``order_by`` values at the cut; ``room``, how many of the
    rows equal to it are still covered; ``equal``, how many there are. Columns ascend, NULL first.
    The order values are read as whole numbers ("digits"). A round counts the rows of each open key in up to
    1,024 bins of one digit, combined before the shuffle, and keeps the bin the cut lies in, so what is left shrinks
    by that factor whatever the count is and however many rows one key has. Cells of at most
    ``cell_rows`` rows are sorted as one array; rows that agree in every digit are one cell and never gathered.
    """
    kinds = {c: rows.schema[c].dataType for c in order_by}
    texts = [c for c in order_by if isinstance(kinds[c], (T.StringType, T.BinaryType))]
    first = _digits(order_by[0], kinds[order_by[0]], 1)[0]
    counted = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.min(first).alias("__low"), F.max(first).alias("__high"),
        *[F.max(F.octet_length(c)).alias(f"__len_{i}") for i, c in enumerate(texts)],
    )
    asked = wanted.select(key, F.col(count).alias("__need")).filter("__need > 0")
    cells = materialize(asked.join(counted, key).filter("__n > __need"), "cells")
    lengths = cells.agg(F.lit(0), *[F.max(f"__len_{i}") for i in range(len(texts))]).first()[1:] if texts else ()
    # The first digit of a text is one of its bytes, as above, whatever its length.
    longest = {c: max(n or 0, 1) for c, n in zip(texts, lengths)}
    digits = [d for c in order_by for d in _digits(c, kinds[c], longest.get(c, 0))]
    cells = cells.select(key, "__need", "__n", F.lit(0).alias("__digit"), "__low", "__high", *_untested())
    open_rows = rows.select(key, F.struct(*order_by).alias("__at"), F.array(*digits).alias("__d"))
    is_big = (F.col("__n") > cell_rows) & (F.col("__digit") < len(digits))
    while not cells.filter(is_big).isEmpty():
        rest = cells.filter(~is_big).select(*cells.columns[:-3], *_untested())
        cells = materialize(_narrowed(open_rows, cells.filter(is_big), key).select(cells.columns).unionByName(rest), "cells")
        inside = F.col("__tested").isNull() | F.get("__d", "__tested").between(F.col("__from"), F.col("__to"))
        kept = open_rows.join(cells.select(key, "__tested", "__from", "__to"), key).filter(inside)
        open_rows = materialize(kept.select(key, "__at", "__d"), "open")
    placed = open_rows.select(key, "__at").join(cells.select(key, "__need", "__n"), key)
    few = placed.filter(F.col("__n") <= cell_rows).groupBy(key).agg(
        F.sort_array(F.collect_list("__at")).alias("__all"), F.first("__need").alias("__need")
    )
    few = few.withColumn("last", F.get("__all", (F.col("__need") - 1).cast("int")))
    before = F.size(F.filter("__all", lambda x: x < F.col("last")))
    few = few.select(
        key, "last", (F.col("__need") - before).alias("room"),
        F.size(F.filter("__all", lambda x: x == F.col("last"))).cast("bigint").alias("equal"),
    )
    flat = placed.filter(F.col("__n") > cell_rows).groupBy(key).agg(
        F.min("__at").alias("last"), F.first("__need").alias("room"), F.first("__n").alias("equal")
    )
    return few.unionByName(flat)
