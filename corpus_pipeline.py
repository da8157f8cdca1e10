"""Documents to packed training sequences: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage gets what the one before kept, reread from Parquet, and hands on the columns of `documents`; the last one
returns where each piece of each document lies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontaminate, language, ngram_join, packing, passages
from lectern.llm.common import shared_dir, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are text of a known language stay."""
    return language.identified_only(docs, language.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five-word shingles, similarity 0.8."""
    return ngram_join.keep_one(docs, at_least=80, width=5)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more stay in the first document that has them."""
    return passages.without_repeats(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies."""
    return packing.packed(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]

#: SQL can express neither the similarity join's index nor the later stages; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, base = table(spark, sf_dir, "documents"), shared_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
