"""The corpus pipeline: five stages from raw documents to a weighted mix.

Every stage takes (spark, docs, sf_dir) and works on all rows the stage before kept; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vejrkraft.llm import decontaminate, importance, jaccard_tree, mixing, passages
from vejrkraft.llm.steps import step


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling keeps."""
    return importance.select_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return jaccard_tree.one_per_class(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that another one keeps; documents that were nothing else go."""
    cut = passages.cut_passages(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; documents it takes nothing of go."""
    return mixing.mix_sources(docs).where("taken > 0")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", test_items),
    ("mixing sources", mix),
]

# Learnt models, chained passages and seeded choices have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir), release=True)
    return STAGES[-1][1](spark, docs, sf_dir)
