"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import (
    chat,
    classifier,
    decontaminate,
    manifest,
    ngrams,
    packing,
    quality,
    repair,
    simhash,
    suffixes,
    superkmers,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    return decontaminate.leak_report(docs, items)


def _on_documents(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": _decontaminate,
        "op2_simhash": _on_documents(simhash.near_report),
        "op3_url_filter": lambda s, d: urls.judge_urls(_table(s, d, "pages")),
        "op4_lm_score": _on_documents(ngrams.lm_report),
        "op5_quality": _on_documents(quality.quality_report),
        "op6_suffix_dedup": _on_documents(suffixes.suffix_report),
        "op7_substring_dedup": _on_documents(superkmers.substring_report),
        "op8_warc": lambda s, d: warc.archive_report(s, _table(s, d, "pages")),
        "op9_chat_format": lambda s, d: chat.chat_report(
            chat.with_probe(s, _table(s, d, "conversations"))
        ),
        "op10_pack": _on_documents(packing.pack),
        "op11_repair": lambda s, d: repair.repair_report(_table(s, d, "conversations")),
        "op12_merkle": _on_documents(manifest.manifest_report),
        "op13_classifier": lambda s, d: classifier.classifier_report(
            _table(s, d, "documents"), _table(s, d, "labels")
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": urls.SQL,
        "op4_lm_score": ngrams.SQL,
        "op5_quality": quality.SQL,
        "op8_warc": warc.SQL,
        "op9_chat_format": chat.SQL,
        "op12_merkle": manifest.SQL,
    }
