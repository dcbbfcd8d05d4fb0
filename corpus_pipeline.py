"""The preparation of a corpus in five stages, each written and read again before the next.

``STAGES`` lists name and function; a function takes the session, the documents that its
predecessor kept and the folder of the tables, and returns the documents that it keeps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelmetrics.llm import decontam, exact_dedup, langid, mixing, simhash
from reelmetrics.sources.scratch import scratch_dir


def _language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language; those that have none noted get the one that is predicted."""
    return langid.keep_identified(docs, most_bits=langid.MOST_BITS)


def _exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the largest id of each text."""
    return exact_dedup.drop_copies(docs, keep="largest")


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return simhash.drop_near_copies(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give each document its rate in the mixture; documents with rate 0 go."""
    return mixing.mixture(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", _language),
    ("exact_dedup", _exact),
    ("simhash_near_dedup", _near),
    ("benchmark_decontamination", _decontaminate),
    ("mixing", _mix),
]

#: Language ID, SimHash and mixing have no counterpart in SQL; tests hold the run against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
