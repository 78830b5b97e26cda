"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, training order.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the
columns of documents; the last returns the training records.  A stage's result is written as
Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.config import scratch_dir
from rollcall.llm import decontamination, simhash, tokens, toxicity
from rollcall.llm.queries import ORDER_KEY, QUERIES, mixed, table
from rollcall.llm.sql import ORACLES

#: No SQL: a trained classifier and a tokenizer decide rows.  Tested against brute force.
ORACLE_SQL = None


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group, the document with the least doc_id stays."""
    return simhash.first_of_each_group(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Six tenths of the tokens, by the weights of domains, languages and sources."""
    return mixed(docs).select(*docs.columns)


def write_training_order(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in training order."""
    return tokens.training_records(docs, ORDER_KEY)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_leaks),
    ("mixing", mix_sources),
    ("training_order", write_training_order),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is kept in the shared scratch folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)


LLM_QUERIES = QUERIES | {"pipeline": run}
LLM_ORACLES = dict(ORACLES)
