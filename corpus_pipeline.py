"""Corpus preparation in five stages over ``documents``: quality rules, line
dedup, near-duplicate removal, PII redaction, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet into the shared folder and rereads them as the
next one's input, so a lost executor costs a stage at most. All but the last
return the columns of documents. Null and empty texts, null ids, repeated rows
and further columns follow the operators' own definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winback.llm import line_dedup, ngram_join, packing, pii, quality_rules
from winback.llm.common import documents, stored

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return line_dedup.drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of smallest id."""
    return ngram_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training sequences."""
    return packing.pack(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("personal_data", personal_data), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
