"""The registered queries of the subpackage, with the SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from promoledger.llm import collocations, grading, jaccard, lattice, lines, mixing, mixing_model, packing, pieces, periods, sentences, sharding, suffixes
from promoledger.operators.relational import repeated

QUERIES: dict = {}
ORACLE: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_mixing(spark, sf):
    rows = repeated(mixing.plan_mix(_read(spark, sf, "documents")), "n_rows")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


@query
def op2_sharding(spark, sf):
    plan = sharding.plan_shards(_read(spark, sf, "documents"))
    return plan.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


@query
def op4_packing(spark, sf):
    return packing.pack(_read(spark, sf, "documents"), with_ids=False)


@query
def op8_quality_rules(spark, sf):
    docs = _read(spark, sf, "documents")
    return lines.apply_quality_rules(docs, lines.fit_line_model(docs, _read(spark, sf, "labels")))


@query
def op9_quality_classifier(spark, sf):
    docs = _read(spark, sf, "documents")
    return grading.grade_documents(docs, grading.fit_grades(docs, _read(spark, sf, "labels")))


@query
def op3_jaccard_join(spark, sf):
    return jaccard.jaccard_components(_read(spark, sf, "documents")).drop("class")


@query
def op7_substring_dedup(spark, sf):
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    return sentences.remove_repeated_passages(docs)


@query
def op6_lattice_near_dedup(spark, sf):
    return lattice.near_duplicate_vectors(_read(spark, sf, "embeddings"))


@query
def op10_context_mixing(spark, sf):
    return mixing_model.score_documents(_read(spark, sf, "documents"))


@query
def op5_suffix_dedup(spark, sf):
    return suffixes.remove_repeated_bytes(_read(spark, sf, "documents"), with_text=False)


@query
def op11_collocations(spark, sf):
    return collocations.mine_collocations(_read(spark, sf, "documents"))


@query
def op12_pieces(spark, sf):
    return pieces.encode_pieces(_read(spark, sf, "documents"), with_ids=False)


@query
def op13_periods(spark, sf):
    return periods.collapse_periodic_runs(_read(spark, sf, "documents"), planted=True)
