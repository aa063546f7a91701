"""From raw documents to token files: five stages, each written as Parquet and read by the next.

1. ``quality``: documents that the repetition rules reject go.
2. ``near_copies``: of documents linked by word shingles, directly or over others, one stays.
3. ``leaks``: documents that hold a benchmark item go.
4. ``mix``: sources are mixed to their target weights; a document may come twice or not at all.
5. ``tokens``: token files are written; a row for each document in them.

A stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the
last return the columns of documents. What happens to nulls, repeated rows and empty
tables is what the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carespan.llm import decontaminate, mixture, ngram_join, quality_rules, token_files
from carespan.llm.storage import kept


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.tokenize(spark, docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("leaks", leaks), ("mix", mix), ("tokens", tokens)]

# The repetition verdict, the tokenizer and chains of links have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
