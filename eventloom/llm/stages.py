"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and applies one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, jaccard, packing, quality, suffixes

# Near-duplicates of whole documents share eight tenths of their five-word shingles.
SHINGLE = 5
SIMILARITY = 0.8

# Rows go to Python workers by this many bytes at a time: a row may hold a block of texts.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_LIMIT = "4m"


def _small_batches(spark: SparkSession) -> None:
    """Bound what an executor and its workers hold of the rows between them.

    Plans read the setting when they run, after the stage has returned, so it stays; a
    value set by the user is left.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, BATCH_LIMIT)


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the policy reject."""
    _small_batches(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each near-duplicate group.

    Candidates of SimHash (operator 2) over five-word shingles, checked and completed by
    the exact similarity.
    """
    _small_batches(spark)
    return jaccard.keep_one(docs, shingle=SHINGLE, similarity=SIMILARITY)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated strings out of texts; documents stay."""
    _small_batches(spark)
    return _counted(suffixes.without_repeats(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes benchmark passages out of texts; mostly contaminated documents go."""
    _small_batches(spark)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _counted(decontaminate.remove_leaks(docs, items))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences; tasks remember few words and forget them, as executors are full by now."""
    _small_batches(spark)
    return packing.pack(docs, remembered=packing.REMEMBERED_LATE, outlives=False)
