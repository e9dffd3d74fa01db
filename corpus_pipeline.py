"""The corpus pipeline: each stage works on all that its predecessor kept.

Stages: toxic documents go, repeated lines go, one document of each group of near copies stays,
documents that contain a benchmark item go, and the rest is packed into token-budget batches.
Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from ledgerloom.llm.store import fresh, prepared, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = fresh(docs, "toxicity")
    return toxicity.score(docs, model, out=name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that loses every line it had goes; ``n_chars`` follows the text."""
    prepared(spark)
    lost = fresh(docs, "n_lines_removed")
    left = line_dedup.dedup_lines(docs, out=lost).where((F.col(lost) == 0) | (F.length(line_dedup.normal(F.col("text"))) > 0))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col(lost) == 0, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
        left = left.withColumn("n_chars", n_chars)
    return left.drop(lost)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return jaccard_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return packing.pack(packing.count_tokens(docs.select("doc_id", "text")).drop("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
ORACLE_SQL = None  # the models and the component search have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents`` on, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        docs = docs if name == STAGES[-1][0] else written(docs)
    return docs
