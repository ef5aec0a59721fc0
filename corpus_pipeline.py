"""The corpus pipeline: stages from raw documents to token ids, each on all that the one before it kept.

Every stage is written as Parquet into the shared folder and read again, so a lost executor costs at most
the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorepipe.llm import common, decontaminate, pieces, quality, simhash, suffix
from scorepipe.session import work_path
from scorepipe.sources.tables import read_parquet


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with all columns; of a repeated id all rows or none."""
    return quality.accepted(docs, read_parquet(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours stays, the one with the smallest id."""
    return simhash.keep_first(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; bytes of strings of 100 bytes that start earlier go from its text, n_chars follows."""
    return suffix.cleaned(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_items(docs, read_parquet(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return pieces.encode(docs, pieces.read_model())


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", benchmark_items),
    ("tokens", tokens),
]

ORACLE_SQL = None
"""Trees, latent search and tokens have no SQL; tests compare every stage with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
