"""The corpus pipeline: language, quality, near copies, mix, packing, in this order.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs. All but the last
return the columns of documents. Stages have the session read Parquet files and hand texts to workers
by few rows, and leave it so: their rows are read after they return.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dugout.llm import jaccard_join, language, mixing, packing, quality
from dugout.llm.common import few_rows, written
from dugout.llm.queries import SEQUENCE, documents, vocabulary

# Near copies share four fifths of their n-grams of five words.
NEAR = jaccard_join.Join(words=5, percent=80)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: rejected ones go."""
    few_rows(spark)
    return language.keep(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the divergence rules."""
    few_rows(spark)
    return quality.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, by the rule for stages: wider than the op 7 query's."""
    few_rows(spark)
    return jaccard_join.keep_one(docs, NEAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    few_rows(spark)
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mixed documents with its sequence and place."""
    few_rows(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), SEQUENCE)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Packing and random mixing have no one SQL answer; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
