"""From raw documents to packed training sequences: five stages, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promoledger.llm import grading, jaccard, mixing, packing, sentences
from promoledger.session import scratch_path, scratch_scope, short_batches


def _documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose chance of the best grade is one half or more."""
    model = grading.fit_grades(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # By place, so that columns of the documents may have the names of the verdict's.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = grading.grade_documents(plain, model, text_col=plain.columns[docs.columns.index("text")], columns=plain.columns)
    return scored.filter("kept").select(plain.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return jaccard.first_of_components(docs, k=5, threshold=jaccard.Threshold(80, 100))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds."""
    return _documents(sentences.remove_repeated_passages(docs, length_col="n_chars"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources have their shares."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut and pack the documents' token ids into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", classify),
    ("jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained weights, hash draws and tokenizer ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents; each result is written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        # What a stage writes besides its result goes when it ends. All rows hold whole texts.
        with scratch_scope(spark), short_batches(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
