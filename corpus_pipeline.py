"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.editmatch import without_benchmark
from tidemark.llm.frames import bounded
from tidemark.llm.hyperdim import keep_languages, learn_profiles, remainder
from tidemark.llm.lines import drop_repeated_lines
from tidemark.llm.packing import pack_documents
from tidemark.llm.probminhash import one_of_each_class
from tidemark.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those without letters go, and those less like it than any learned one of their size."""
    docs, learn = _ready(spark, docs), remainder("doc_id", 3) != 1
    return keep_languages(docs, learn_profiles(docs.where(learn)), learn=learn)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are, or nearly are, lines of earlier ones."""
    return drop_repeated_lines(_ready(spark, docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return one_of_each_class(_ready(spark, docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_benchmark(_ready(spark, docs), spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of the documents in sequences of several lengths."""
    return pack_documents(_ready(spark, docs))


def _ready(spark: SparkSession, docs: DataFrame) -> DataFrame:
    bounded(spark)
    return docs


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

# Neither the models nor the similarity searches can be said in SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = stored(docs, f"stage-{name}")
    return docs
