"""Corpus pipeline: toxic documents go, exact and near copies go, contaminated documents go, then sources are mixed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and
reread as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codetrail.llm import decontaminate, exact_dedup, mixing, simhash_dedup, toxicity
from codetrail.llm.common import limit_batches, table, written


def stage(f):
    """A stage's result is lazy and written by the caller: its tasks get small Arrow batches."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark)
        return f(spark, docs, sf_dir)

    run_stage.__doc__ = f.__doc__
    return run_stage


@stage
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3, mod=4, held=2)


@stage
def exact_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


@stage
def simhash_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return simhash_dedup.drop_near_copies(docs, shingle=3, max_bits=2)


@stage
def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=13)


@stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken of each."""
    return mixing.mix_documents(docs, weights=(5, 2, 1), max_epochs=3, share=1.0, seed=42)


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_dedup_filter),
    ("simhash near-dedup", simhash_filter),
    ("benchmark decontamination", decontamination_filter),
    ("mixing sources", source_mix),
]

#: The first stages learn a model and hash shingles, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = written(f(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
