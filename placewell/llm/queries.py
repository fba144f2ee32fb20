"""One query per operator over the given tables, and the checking SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placewell.llm import (
    byte_bpe, html_text, licenses, near_dedup, neighbours, packing, periodic_runs, quality_classifier,
    quality_rules, repeated_spans, token_counts, token_links, url_filters,
)
from placewell.llm.oracle import ORACLE
from placewell.llm.workers import importable

UNITS = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(UNITS))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", "licence.sentence_ids", "licence.n_sentences",
        F.array_join("licence.names", ",").alias("licences"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(UNITS))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "sampling.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality_rules.judge(
        docs, public_tokenizers.path(PIECES), public_tokenizers.path(UNITS))
    return judged.select("doc_id", "rules.quality.*", "rules.base_failed", "rules.kept")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "is_kept")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    edges = url_filters.page_edges(pages)
    return url_filters.judge_urls(pages.select("page_id", "url"), edges).select("page_id", "judged.*")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.find_runs(docs))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_links.align(
        table(spark, sf_dir, "documents"), public_tokenizers.path(UNITS), public_tokenizers.path(PIECES), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_packing, op2_license_scan, op3_byte_bpe, op4_token_counts, op5_quality_classifier,
        op6_quality_rules, op7_near_dedup, op8_html_extraction, op9_url_filters, op10_nearest_neighbours,
        op11_periodic_runs, op12_token_alignment, op13_repeated_spans)
}
__all__ = ["ORACLE", "QUERIES"]
