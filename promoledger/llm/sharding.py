"""Proportional stratified interleaving: shards that all have the mixture of the whole.

Rows of a source are shuffled by a seeded hash and ranked; rank / rows of the source is a row's
fractional rank. Sorted by it, every stretch of the table holds each source in proportion, so equal
cuts are shards. Both rankings work in hash and rank buckets of bounded size: a row's rank is its
rank inside the bucket plus the rows of earlier buckets, so no source is ever sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promoledger.session import materialize

SHARDS, SEED, BUCKET_ROWS = 16, 7919, 20_000


def _positions(rows: DataFrame, keys: list[str], bucket: Column, order: list[Column], column: str) -> DataFrame:
    """Add 0-based positions per key: earlier buckets' rows plus the position inside the bucket."""
    rows = rows.withColumn("__b", bucket)
    counts = rows.groupBy(*keys, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    right = counts.select(*[F.col(k).alias(f"__r_{k}") for k in keys], F.col("__b").alias("__r_b"), "__before")
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys] + [F.col("__b") == F.col("__r_b")]
    inside = F.row_number().over(Window.partitionBy(*keys, "__b").orderBy(*order)) - 1
    placed = rows.withColumn("__in", inside).join(right, same)
    return placed.withColumn(column, F.col("__before") + F.col("__in")).drop("__b", "__in", "__before", "__r_b", *[f"__r_{k}" for k in keys])


def plan_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(doc_id, source, size, text_crc32, shard, slot) of every row; ``size`` is UTF-8 bytes + 1.

    Rows per shard differ by one at most. The text is read once. NULL ids, sources and texts (no
    bytes, checksum 0) are values like others; repeated rows get a slot each; an empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
    )
    rows = materialize(rows.withColumn("__h", F.xxhash64("doc_id", "text_crc32", "size", F.lit(seed))), "shard-rows")
    n = rows.count()
    buckets = F.lit(max(1, -(-n // bucket_rows)))
    # Top bits of a uniform hash: equal shares of the rows, in hash order.
    by_hash = F.floor((F.col("__h") / float(1 << 64) + 0.5) * buckets)
    ranked = _positions(rows, ["source"], by_hash, [F.col("__h"), F.col("doc_id"), F.col("size"), F.col("text_crc32")], "__rank")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("__rows")).withColumnRenamed("source", "__s")
    ranked = ranked.join(sizes, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    part = (2 * F.col("__rank") + 1) / (2 * F.col("__rows"))
    ranked = materialize(ranked.withColumn("__part", part), "shard-ranks")
    by_part = F.floor(F.col("__part") * buckets)
    ordered = _positions(ranked.withColumn("__all", F.lit(0)), ["__all"], by_part, [F.col("__part"), F.col("source"), F.col("__rank")], "__at")
    shard = F.expr(f"(__at * {shards}) div {max(n, 1)}").cast("int")
    first = F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")
    return (
        ordered.withColumn("shard", shard)
        .withColumn("slot", (F.col("__at") - first).cast("long"))
        .select("doc_id", "source", "size", "text_crc32", "shard", "slot")
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> None:
    """Write ``docs`` as Parquet below ``path``, a folder per shard, rows in slot order in each file.

    The folders are named ``shard_no=N``, with underscores added if ``docs`` has such a column. Rows that
    agree in id, source and text take the slots of their group in any order.
    """
    plan = plan_shards(docs, id_col, text_col, source_col, **options)
    same = ["doc_id", "source", "size", "text_crc32"]
    again = Window.partitionBy(*same).orderBy("shard", "slot")
    plan = plan.withColumn("__k", F.row_number().over(again)).select(*[F.col(c).alias(f"__{c}") for c in same], "__k", "shard", "slot")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.col(id_col).alias("__i"),
        F.col(source_col).cast("string").alias("__s"),
        (F.octet_length(text) + 1).cast("long").alias("__z"),
        F.crc32(F.encode(text, "utf-8")).alias("__c"),
    )
    keyed = keyed.withColumn("__n", F.row_number().over(Window.partitionBy("__i", "__s", "__z", "__c").orderBy(F.lit(0))))
    pairs = zip(["__i", "__s", "__z", "__c", "__n"], ["__doc_id", "__source", "__size", "__text_crc32", "__k"], strict=True)
    joined = keyed.join(plan, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])
    joined = joined.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot")
    folder = "shard_no"
    while folder in {c.lower() for c in docs.columns}:
        folder += "_"
    joined.select("__row.*", F.col("shard").alias(folder)).write.partitionBy(folder).parquet(path)
