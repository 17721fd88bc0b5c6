"""Registered queries of the operators: thin wrappers that derive the contract's columns."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulfilq.llm import (
    dart_minhash,
    decontaminate,
    fertility,
    hash_ring,
    kneser_ney,
    length_histogram,
    license_join,
    line_bitmap,
    periodic_runs,
    pii_tagger,
    pivotal_mix,
    url_markov,
    whitening,
)
from fulfilq.llm.common import slices, table
from fulfilq.llm.pii_rules import KINDS


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(fertility.measure(table(spark, sf_dir, "documents")))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    trusted = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return kneser_ney.classify(table(spark, sf_dir, "documents"), trusted)


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dart_minhash.classes(table(spark, sf_dir, "documents"))
    stays = F.col("node").eqNullSafe(F.col("lead")) & F.col("doc").eqNullSafe(F.col("class_id"))
    return found.select(F.col("doc").alias("doc_id"), "class_id", "class_size", stays.alias("kept"))


def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.histogram(length_histogram.lengths(table(spark, sf_dir, "documents")))


def op5_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(table(spark, sf_dir, "documents"), across_lines=True)


def op6_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_markov.judge(table(spark, sf_dir, "pages"))


def op7_pii_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii_tagger.find(docs, pii_tagger.train(docs))

    def count(kind):
        return F.size(F.filter("base", lambda x: x.startswith(kind + ":"))).cast("bigint").alias(f"n_{kind}")

    n = [count(kind) for kind in KINDS]
    return found.select(
        "doc_id", *n, F.sha2(F.array_join("base", ","), 256).alias("base_sha256"), F.array_join("spans", ",").alias("spans")
    )


def op8_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = pivotal_mix.copies(pivotal_mix.units(table(spark, sf_dir, "documents")))
    return plan.select(
        "id.doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op9_fm_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.hits(docs, table(spark, sf_dir, "benchmark")).drop("text")
    spans = F.col("__spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ","), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def _kept_digests(batches):
    for b in slices(batches, "text"):
        texts = b.column("text").to_pylist()
        n, keep = b.column("__n_lines").to_pylist(), b.column("__keep").to_pylist()
        digest = [
            hashlib.sha256(line_bitmap.kept_text(t or "", k, m).encode()).hexdigest()
            for t, k, m in zip(texts, keep, n, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("__n_lines"), b.column("__n_dropped"), pa.array(digest, pa.string())],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )


def op10_line_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return line_bitmap.apply_bitmaps(
        docs,
        line_bitmap.keep_bitmaps(docs),
        _kept_digests,
        "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    )


def planted_source(doc_id, n: int):
    """Every tenth document repeats a stretch of its words up to its end: the word number each word is copied from."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(table(spark, sf_dir, "documents"), planted_source)
    runs = F.col("runs")
    # greatest length / period; runs come by start, then period, so an equal one never replaces the first
    best = F.aggregate(
        runs, F.get(runs, 0), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b)
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size(runs).cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = hash_ring.assign(rows, ["doc_id"], 40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {
    "op1_fertility": op1_fertility,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_length_histogram": op4_length_histogram,
    "op5_license_join": op5_license_join,
    "op6_url_markov": op6_url_markov,
    "op7_pii_tagger": op7_pii_tagger,
    "op8_pivotal_mix": op8_pivotal_mix,
    "op9_fm_decontamination": op9_fm_decontamination,
    "op10_line_bitmap": op10_line_bitmap,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_hash_ring": op13_hash_ring,
}
