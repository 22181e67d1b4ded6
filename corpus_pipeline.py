"""From raw documents to packed sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.line_duplicates import without_repeated_lines
from tagloom.llm.mixing import mixed
from tagloom.llm.near_duplicates import keep_one_of_each_group
from tagloom.llm.packing import packing
from tagloom.llm.rule_ensemble import keep_good
from tagloom.llm.scratch import Scratch

#: The stages train a model, hash texts and tokenise: no SQL expresses them.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier finds good."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines, short ones included, that resemble an earlier one; those of which nothing is left go."""
    names = docs.columns
    return without_repeated_lines(docs, least=1).where("_removed = 0 OR _left > 0").select(names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8)."""
    return keep_one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again as the weights ask for."""
    return mixed(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
