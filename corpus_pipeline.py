"""A training-corpus pipeline: STAGES from documents to packed sequences, each on what the one before kept.

Every stage reads the written result of the one before.  All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwell.llm import packing
from tierwell.llm.language import keep_known_language
from tierwell.llm.simhash import keep_one_each
from tierwell.llm.substrings import drop_repeats
from tierwell.llm.toxicity import keep_harmless
from tierwell.sources.shared import stored
from tierwell.tuning import tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model can tell."""
    return keep_known_language(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the model does not call toxic; labels come from the table beside the documents."""
    return keep_harmless(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by their fingerprints, as op1 links them, the one with the smallest id."""
    return keep_one_each(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words that occur more than once."""
    return drop_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.digest(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]

#: Models are trained in two stages, which SQL cannot express; tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``; each result is written as Parquet and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
