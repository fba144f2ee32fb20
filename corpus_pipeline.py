"""From raw documents to packed sequences: quality, rules, near-duplicates, packing.

Each stage takes the rows that the one before it kept, written as Parquet and read again.
All stages but the last return the columns of documents, whatever their names; columns
that a stage works with lie in a struct of its own until they are dropped. No rows give no
rows in every stage. Repeated rows are documents of their own until the near-duplicates
go. What each stage does with nulls, empty and very long texts, and ties is said there.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from placewell.llm.components import discard, stored
from placewell.llm.near_dedup import drop_near_duplicates
from placewell.llm.packing import pack
from placewell.llm.quality_classifier import classify
from placewell.llm.quality_rules import judge
from placewell.llm.workers import importable

UNITS = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps.

    Null and empty texts have no weight and go; a text without words that the models know
    is weighed by what it has, however long it is. Rows that tie with the last of the
    sample are kept too. Null ids match no label. Without labels every text is kept.
    """
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels).where("sampling.kept").drop("sampling")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the bands of their language and length.

    Null and empty texts have no words and go. Null is a language of its own; a language of
    few texts has bands as wide as these demand. Whole texts are measured; equal rows are
    judged alike.
    """
    importable(spark)
    judged = judge(docs, public_tokenizers.path(PIECES), public_tokenizers.path(UNITS))
    return judged.where("rules.kept").drop("rules")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id.

    Null texts are in no class and stay; texts without words are copies of each other. Of
    rows with the same id and words one stays, the first by a hash of the whole row. Null
    ids count as smaller than all others.
    """
    importable(spark)
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences.

    Null and empty texts are one id, the end mark; long texts are cut as needed. Rows with
    null or repeated ids are documents of their own.
    """
    importable(spark)
    return pack(docs, public_tokenizers.path(UNITS))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]
ORACLE_SQL = None  # hashed n-gram models, vocabularies and alignment are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
