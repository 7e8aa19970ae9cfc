"""Corpus pipeline: toxicity, near-duplicates, decontamination, secrets, mixing, in this order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakelens.llm import decontaminate, mixing, secrets, simhash, toxicity
from lakelens.session import work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on ``labels``, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that of the smallest doc_id."""
    return simhash.keep_one(docs, shingle=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a ``benchmark`` item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` counted anew."""
    return secrets.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as its copies, sources weighing 1, 2, 3 in turn."""
    return mixing.mix(docs, weights=(1.0, 2.0, 3.0), cap=3.0)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: trained and randomised stages have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
