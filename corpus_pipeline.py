"""A training corpus from the documents table: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import stage_path, table
from tabulon.llm.decontam import decontaminated
from tabulon.llm.jaccard import distinct_documents
from tabulon.llm.mixing import mixed_documents
from tabulon.llm.sharding import shard
from tabulon.llm.toxicity import reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard(docs).withColumn("shard", F.col("shard").cast("int"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Automata, fingerprints and draws have no SQL form; tests/llm/test_pipeline.py holds the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, writing and rereading the result of all but the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = stage_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
