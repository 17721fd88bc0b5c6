"""Exact length histogram in tokens (operator 4).

Documents are aggregated by encoded length (whole texts, one public
vocabulary); prefix and suffix sums over the distinct lengths then answer, for
every context limit, how many documents and tokens lie within it and how many
tokens remain when longer documents are cut there. Sums run in two levels
(blocks of lengths, then lengths inside a block), so no task takes more than
one block of lengths.

Null or empty text has length 0. Repeated rows count each. No rows: an empty
histogram; totals and quantiles of it are 0 and None. Very long texts are encoded
whole. Only doc_id and text are read, other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulfilq.llm import tokenizers
from fulfilq.llm.common import materialize, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BLOCK = 1024


def lengths(docs: DataFrame, folder: str = tokenizers.FOLDER, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs`` (doc_id, text)."""
    shipped = tokenizers.ship(docs.sparkSession, vocabulary, folder)

    def run(batches):
        enc = tokenizers.rank_encoder(shipped, vocabulary)
        for b in slices(batches, "text"):
            texts = b.column("text").to_pylist()
            n = np.fromiter((len(tokenizers.encode_ordinary(enc, t or "")) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n)], ["doc_id", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint")


def histogram(lens: DataFrame) -> DataFrame:
    """One row per distinct length: its documents and tokens, and the sums up to and beyond it.

    ``kept_tokens`` is the total when every document is cut at this length.
    """
    base = lens.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    base = base.withColumns({"tokens": F.col("n_tokens") * F.col("n_docs"), "block": F.floor(F.col("n_tokens") / BLOCK)})
    base = materialize(base, "lengths")  # a row per distinct length; read twice, the texts are encoded once
    blocks = base.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per 1,024 lengths: a handful of rows whatever the corpus holds
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bd").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("bt").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("bd").over(whole).alias("all_docs"),
        F.sum("bt").over(whole).alias("all_tokens"),
    )
    inner = Window.partitionBy("block").orderBy("n_tokens")
    out = base.join(blocks, "block").select(
        "n_tokens",
        "n_docs",
        "tokens",
        (F.col("docs_before") + F.sum("n_docs").over(inner)).alias("docs_within"),
        (F.col("tokens_before") + F.sum("tokens").over(inner)).alias("tokens_within"),
        "all_docs",
        "all_tokens",
    )
    return out.withColumns(
        {
            "docs_beyond": F.col("all_docs") - F.col("docs_within"),
            "tokens_beyond": F.col("all_tokens") - F.col("tokens_within"),
        }
    ).withColumns(
        {
            "kept_tokens": F.col("tokens_within") + F.col("n_tokens") * F.col("docs_beyond"),
            "quantile": F.col("docs_within") / F.col("all_docs"),
        }
    )


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens left when every document is cut at ``limit`` tokens."""
    row = hist.agg(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs"))).first()
    return int(row[0] or 0)


def quantile(hist: DataFrame, q: float) -> int | None:
    """Least length that at least a share ``q`` of the documents do not exceed."""
    row = hist.where((F.col("docs_within") >= q * F.col("all_docs"))).agg(F.min("n_tokens")).first()
    return row[0]
