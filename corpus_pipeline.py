"""Cleaning and mixing of a corpus in five stages.

Each stage takes the documents that the one before kept, as a table in files, and returns
documents. The last one adds the probability with which a document was sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmill.llm.decontaminate import without_benchmark
from starmill.llm.jaccard_join import one_per_group
from starmill.llm.line_dedup import deduplicated
from starmill.llm.mixing import mixed
from starmill.llm.toxicity import without_toxic
from starmill.sources.stage import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labels does not reject."""
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without long lines that five or more of them hold, but for one."""
    return deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 80 % of its shingles of five words."""
    return one_per_group(docs, words_per_shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words running of a benchmark item."""
    return without_benchmark(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target shares of source, language and topic."""
    return mixed(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The model of the first stage cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs, _ = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
