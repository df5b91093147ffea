"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

Toxic documents go; lines that came before go; one document of each near-duplicate group stays;
documents contaminated by benchmark passages go; what is left is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import bpe, common, decontamination, line_dedup, near_copies, simhash, toxicity


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted model does not call toxic."""
    model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    return model.score(docs, name="_score").filter("_score < 0.5").select(*docs.columns)


def lines_once(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that came before, however short (blank ones stay); ``n_chars`` follows the text."""
    out = line_dedup.dedup(docs, exact_chars=1)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies: candidates by fingerprints as in op9 (SimHash, 4 bits)
    and, for copies beyond 4 bits, by bands of minhashes; all checked exactly (five-word shingles, Jaccard similarity of 0.8)."""
    return near_copies.keep_first(docs, radius=simhash.RADIUS)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return decontamination.remove_documents(docs, common.table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the decoded text."""
    return bpe.encode(docs)


STAGES = [
    ("toxicity", toxic_out),
    ("line_dedup", lines_once),
    ("simhash_near_dedup", near_duplicates_out),
    ("decontamination", benchmark_out),
    ("bpe", encoded),
]

#: Trees and fingerprints have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
