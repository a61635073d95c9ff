"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the next one's input.

1. quality: documents that the quality operator rejects go;
2. near_dedup: one document of each near-duplicate group stays;
3. substring_dedup: later copies of repeated passages are cut out of their texts;
4. decontaminate: documents contaminated by the benchmark go;
5. pack: what is left becomes token sequences.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlake.llm.common import staged, table
from barlake.llm.decontam import remove_contaminated
from barlake.llm.minhash import remove_near_duplicates
from barlake.llm.packing import pack
from barlake.llm.quality import keep_good
from barlake.llm.substring import remove_passages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(spark, docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_near_duplicates(spark, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_passages(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).drop("ids")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("pack", packing),
]

# Fitting a classifier and tokenising are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
