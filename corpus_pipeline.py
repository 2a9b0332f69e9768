"""From raw documents to packed training sequences, in five stages.

Each stage is written as Parquet and read again before the next one. Stages work on
everything their predecessor kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import stages
from eventloom.llm.blocks import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", stages.quality_rules),
    ("near dedup", stages.near_dedup),
    ("suffix-array dedup", stages.suffix_dedup),
    ("decontamination", stages.decontamination),
    ("packing", stages.packing_stage),
]

# Fingerprints, byte spans and packing cannot be expressed in SQL; tests compare the
# stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, "stage")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
