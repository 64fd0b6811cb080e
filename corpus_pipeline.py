"""The corpus pipeline: five operators in a row, each over what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchtide.llm import importance, mixing, sharding, simhash_ring, templates
from watchtide.llm.common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents outside the importance sample go."""
    return importance.kept_documents(docs, table(spark, sf_dir, "labels"), errors=0.0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5 (3-word shingles, 2 bits): one document of each group stays."""
    return simhash_ring.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return templates.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents stay as often as the mixture takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the documents with their shard and slot."""
    return sharding.sharded_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("mix", mix), ("shard", shard)]

#: SQL lacks the hashes and the model that these stages decide by; tests/llm holds each
#: stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
