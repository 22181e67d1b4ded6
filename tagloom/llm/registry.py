"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.fill_in_middle import fill_in_middle_digests
from tagloom.llm.hamming import nearest
from tagloom.llm.host_rules import host_rules
from tagloom.llm.line_duplicates import without_repeated_lines
from tagloom.llm.main_text import main_text
from tagloom.llm.mixing import mixture
from tagloom.llm.near_duplicates import near_duplicates
from tagloom.llm.oracle import SQL as _SQL
from tagloom.llm.packing import packing
from tagloom.llm.periodic_runs import periodic_runs_digest
from tagloom.llm.pii import personal_data_digest
from tagloom.llm.repeated_spans import without_repeated_spans
from tagloom.llm.rule_ensemble import scored
from tagloom.llm.secrets import secrets_digest


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_host_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules(_read(spark, sf_dir, "documents"))


def op2_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing(_read(spark, sf_dir, "documents"))


def op3_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_spans(_read(spark, sf_dir, "documents"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), shingle_words=2)


def op5_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_read(spark, sf_dir, "embeddings"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_digest(_read(spark, sf_dir, "documents"))


def op7_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_read(spark, sf_dir, "documents"))


def op8_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_read(spark, sf_dir, "pages"))


def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeated_lines(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "text", F.col("_removed").cast("long").alias("n_removed"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs_digest(_read(spark, sf_dir, "documents"))


def op12_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_digest(_read(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle_digests(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_host_quality_rules,
        op2_bm25_packing,
        op3_sentence_span_dedup,
        op4_minhash_near_dedup,
        op5_hamming_top_k,
        op6_personal_data,
        op7_temperature_mixing,
        op8_rule_ensemble_quality,
        op9_main_text,
        op10_fuzzy_line_dedup,
        op11_periodic_runs,
        op12_secret_ownership,
        op13_fill_in_middle,
    )
}

SQL: dict[str, str] = dict(_SQL)
