"""The queries of this package and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    bpe, divergence, fingerprint, html_text, language, licenses, neighbours, ngram_join, packing, phrases, toxicity, urls, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judged(_table(spark, sf, "pages"))


def op2_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf, "documents"))


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf, "documents"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf, "pages"))


def op5_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours.neighbours(_table(spark, sf, "embeddings"))


def op6_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.language_id(_table(spark, sf, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_table(spark, sf, "documents"))


def op8_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_findings(_table(spark, sf, "documents"))


def op9_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.fingerprints(_table(spark, sf, "documents"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op11_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extracted(_table(spark, sf, "pages"))


def op12_phrase_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf, "documents"))


def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(_table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_ngram_jaccard_join, op3_byte_bpe, op4_warc, op5_nearest_neighbours, op6_language_id,
        op7_best_fit_packing, op8_license_scans, op9_fingerprints, op10_toxicity, op11_html_extraction, op12_phrase_collocations,
        op13_source_divergence,
    )
}

ORACLES: dict[str, str] = {
    "op12_phrase_collocations": phrases.SQL,
    "op13_source_divergence": divergence.SQL,
}
