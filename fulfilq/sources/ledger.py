"""Ledger of files already taken in (S2, S4, S9d): path, size and time of each, per consumer.

A flat dataset is one snapshot that is landed again and again. A run that finds
the files its last successful run took in has nothing to do. Each consumer's
newest list is a small Parquet table beside the audit log, swapped in whole.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fulfilq.sources import storage

SCHEMA = "path string, size bigint, modified bigint, taken_at timestamp"


def unchanged(spark: SparkSession, ledger: str, name: str, files: list[storage.FileInfo]) -> bool:
    """Whether ``files`` are exactly those of the last ``record``."""
    path = f"{ledger.rstrip('/')}/{name}"
    storage.recover_swap(spark, path)
    if not storage.has_data(spark, path):
        return False
    rows = spark.read.schema(SCHEMA).parquet(path).select("path", "size", "modified").collect()  # one per file
    return sorted(tuple(r) for r in rows) == sorted(tuple(f) for f in files)


def record(spark: SparkSession, ledger: str, name: str, files: list[storage.FileInfo]) -> None:
    """Remember ``files`` as taken in; call it when the work on them is done."""
    path = f"{ledger.rstrip('/')}/{name}"
    rows = spark.createDataFrame([tuple(f) for f in files], "path string, size bigint, modified bigint")
    staged = storage.beside(path)
    rows.withColumn("taken_at", F.current_timestamp()).coalesce(1).write.parquet(staged)
    storage.swap_in(spark, staged, path)
