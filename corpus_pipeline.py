"""From raw documents to packed training sequences: five stages over the ``documents`` table of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnkit.llm import stages
from tarnkit.llm.components import stored
from tarnkit.llm.packing import pack_documents
from tarnkit.llm.queries import word_bpe
from tarnkit.llm.workers import importable


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return stages.keep_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return stages.keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return stages.keep_one_of_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return stages.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return pack_documents(docs, word_bpe())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Learnt models and tokens are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces; each stage's documents are stored in the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
