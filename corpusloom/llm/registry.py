"""Queries of the training-data operators: opN_<name>(spark, sf_dir), and the SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import htmltext, langid, mixing, neardup, packing, quality, rules, secrets, sharding, stages, topk


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(packing.pack_documents(table(spark, sf_dir, "documents")))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf_dir, "pages"), keep=("page_id", "url"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rules_digest(rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_digest(sharding.assign_shards(table(spark, sf_dir, "documents")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_digest(mixing.mix_sources(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.langid_digest(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.neardup_digest(neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4))


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_sharding": op6_sharding,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing": op8_mixing,
    "op9_language_id": op9_language_id,
    "op10_near_duplicates": op10_near_duplicates,
}

QUERIES["pipeline"] = stages.run

ORACLE_SQL: dict[str, str] = {
    "op4_secret_scans": secrets.ORACLE_SQL,
    "op5_exact_top_k": topk.ORACLE_SQL,
    "op10_near_duplicates": neardup.ORACLE_SQL,
}
