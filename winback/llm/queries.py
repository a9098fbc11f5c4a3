"""Registered queries of the corpus operators: thin wrappers that run an
operator with production parameters on its whole table and derive the digest
columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm import (bpe, hard_negatives, html_extract, imatch, license_scan, line_dedup, ngram_join, oracle, packing,
                         pii, ppm, prefix_trie, quality_rules, suffix_dedup)
from winback.llm.common import documents


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_figures(documents(spark, sf_dir),
                                         spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (suffix_dedup.cut_repeats(documents(spark, sf_dir))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pii.find_spans(documents(spark, sf_dir))
    return d.select("doc_id", *[F.size(f"{k}_spans").cast("long").alias(f"n_{k}") for k in pii.KINDS],
                    F.sha2(pii.spans_string(pii.BASE_KINDS), 256).alias("base_sha256"),
                    pii.spans_string(pii.KINDS).alias("spans"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edit_pairs(documents(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (license_scan.scan(documents(spark, sf_dir))
            .select("doc_id", "n_candidates", F.array_join("licenses", ",").alias("licenses"),
                    "saving", "differences"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (line_dedup.drop_boilerplate(documents(spark, sf_dir), counts=True)
            .select("doc_id", "source", "n_lines", "n_dropped",
                    F.length("text").cast("long").alias("n_chars_kept"),
                    F.sha2("text", 256).alias("kept_sha256")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ppm_score": op1_ppm_score,
    "op2_ngram_join": op2_ngram_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_pii": op5_pii,
    "op6_bpe": op6_bpe,
    "op7_packing": op7_packing,
    "op8_imatch": op8_imatch,
    "op9_license_scan": op9_license_scan,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_extract": op12_html_extract,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLE_SQL: dict[str, str] = {
    "op10_line_dedup": oracle.OP10,
    "op11_hard_negatives": oracle.OP11,
    "op13_prefix_trie": oracle.OP13,
}
