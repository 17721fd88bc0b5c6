"""Corpus pipeline: quality rules, line dedup, near dedup, decontamination, mixing.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``documents``.
The last returns the mix: a row per copy taken, numbered by ``copy``.

``run`` writes each stage to the shared checkpoint folder, so a lost executor
costs at most the running stage, and removes it when the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fulfilq.llm import dart_minhash, decontaminate, fertility, line_bitmap, pivotal_mix
from fulfilq.llm.common import discard, materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the word rules or the tokenizer bands reject."""
    return fertility.reject(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier document holds."""
    return line_bitmap.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return dart_minhash.one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every occurrence of a benchmark window out of the texts."""
    return decontaminate.cut(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some more than once, so that the sources meet their weights."""
    return pivotal_mix.mixed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
]

#: Signatures and seeded rounding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
        if last is not None:
            discard(last)
        last = docs
    return docs
