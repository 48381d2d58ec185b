"""Corpus pipeline: the documents table through the text operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a stage
returns as Parquet below the cluster's shared folder and hands the reread table to the next, so
an executor lost in one stage costs nothing of the stages before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import exact_dedup, mixing, near_dedup, packing, quality_rules
from sensorlake.llm.common import ship_code, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the repetition rules reject."""
    ship_code(spark)
    return quality_rules.filter_quality(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of equal texts."""
    ship_code(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    ship_code(spark)
    return near_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, a row for each pass over its source."""
    mixed = mixing.mixed_documents(docs)
    if "n_chars" in mixed.columns:
        mixed = mixed.withColumn(
            "n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return mixed


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the mixed documents, each with its sequence and its place there."""
    ship_code(spark)
    return packing.packed_documents(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

# Hashes over n-grams, signatures and solver steps have no SQL form; tests/llm checks the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
