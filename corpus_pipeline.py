"""Corpus pipeline: from raw documents to packed batches of clean, distinct ones."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidegauge.llm import decontam, exact_stream, jaccard, packing, quality  # noqa: E402
from tidegauge.llm.store import findable, released, written  # noqa: E402


def _begin(spark: SparkSession) -> None:
    """Workers find the package; what the stage before left in the driver and on disk goes."""
    findable(spark)
    released(spark)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality views keep."""
    _begin(spark)
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id."""
    _begin(spark)
    return exact_stream.kept(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8), the document with the smallest id."""
    _begin(spark)
    return jaccard.kept(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    _begin(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    _begin(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", batches),
]
#: The classifier and the latent space have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
