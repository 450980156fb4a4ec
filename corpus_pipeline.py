"""A corpus pipeline of the llm operators: language, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
applies them to the documents table, writing each stage's result as Parquet
to the shared folder and reading it again as the next one's documents.  The
first three return the columns of documents, for the rows that stay; the
last returns the packed sequences.

In all stages texts are read whole, an empty table gives an empty result, and
columns beyond those of documents are passed on as they are, but by packing.
NULL and empty texts end with the language stage.  Rows with a NULL doc_id
are judged like others, linked with none, and kept by dedup; repeated rows
are judged alike by the first two stages, and dedup keeps one of a doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimstar.llm import langid, neardup, packing, repetition
from dimstar.llm.common import materialize, read


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the identifier accepts.  It learns from the stage's own labelled documents."""
    return langid.keep(docs, langid.fit(langid.training_rows(docs)))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of all documents in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("quality_rules", quality_stage),
    ("near_dedup", dedup_stage),
    ("packing", packing_stage),
]

# Trained models and iterated joins: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
