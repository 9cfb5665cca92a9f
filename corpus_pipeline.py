"""A corpus pipeline over ``documents``: quality, near copies, benchmark passages, personal data, tokens.

Each stage is a function of (spark, docs, sf_dir) over the rows that the one before it kept. All but the last return the
columns of their input, so a stage can be left out or run alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewind.llm import byte_bpe, decontamination, pii, quality, simhash_dedup
from tradewind.llm.queries import vocabulary
from tradewind.llm.tables import stored
from tradewind.llm.text import documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a posterior probability of good quality under one half go."""
    return quality.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays."""
    return simhash_dedup.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind."""
    return pii.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded bytes."""
    return byte_bpe.digests(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("near copies", near_copies),
    ("benchmark passages", benchmark_passages),
    ("personal data", personal_data),
    ("tokens", tokens),
]

# SQL has no SimHash and no byte-level BPE; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
