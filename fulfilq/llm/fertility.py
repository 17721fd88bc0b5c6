"""Quality rules by tokenizer fertility (operator 1).

Two public vocabularies measure every whole text: a byte-level BPE gives
characters per token and the entropy of the document's own token distribution;
a piece vocabulary with byte fallback, applied to each distinct word, gives the
share of pieces that fell back to bytes. A document is rejected when a measure
leaves the band of its language (``BANDS``; ``None`` is the band of languages
not listed). Word and repetition counts are measured in the same pass.

One Arrow pass, no shuffle. Null or empty text: no words, measures 0, base rule
fails. Null language: the default band. Repeated rows: one result row each. Very
long texts, runs of one character among them, are measured whole. ``measure``
reads doc_id, lang and text; ``reject`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulfilq.llm import tokenizers
from fulfilq.llm.common import NON_SPACE, Words, mix64, per_doc, slices, text_buffer

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
WINDOW = 8
#: language -> (least, most characters per token, most byte-fallback share, least entropy bits).
#: Prose gives well over 2 characters per token and over 5 bits; symbol litter, byte soup and
#: padding fall below. Languages with accents get a little more room.
BANDS = {
    "en": (2.0, 8.0, 0.10, 3.0),
    "de": (2.0, 8.0, 0.10, 3.0),
    "fr": (1.9, 8.0, 0.10, 3.0),
    "es": (1.9, 8.0, 0.10, 3.0),
    None: (0.5, 12.0, 0.50, 2.5),
}
SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])

SCHEMA = (
    "doc_id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_tokens bigint, chars_per_token double, byte_fallback_share double, token_entropy double"
)


def repeated_words(ids: np.ndarray, words: Words) -> np.ndarray:
    """Words of each document that lie in a window of 8 words found twice or more in it.

    A 64-bit hash finds the candidates; their words are then compared exactly.
    """
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(words.count), np.int64)
    h = words.doc[:n].astype(np.uint64)
    for j in range(WINDOW):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + ids[j : n + j].astype(np.uint64) + np.uint64(1))
    inside = np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1 :])
    order = inside[np.argsort(h[inside])]
    same = h[order][1:] == h[order][:-1]
    cand = np.zeros(len(order), bool)
    cand[1:] |= same
    cand[:-1] |= same
    at = np.sort(order[cand])
    if not len(at):
        return np.zeros(len(words.count), np.int64)
    key, top = words.doc[at].astype(np.int64), int(ids.max()) + 1
    for j in range(WINDOW):
        key = np.unique(key * top + ids[at + j], return_inverse=True)[1]
    at = at[np.bincount(key)[key] > 1]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + WINDOW, -1)
    hit = np.cumsum(cover[:-1]) > 0
    return np.bincount(words.doc[hit], minlength=len(words.count)).astype(np.int64)


def duplicate_lines(buf: np.ndarray, off: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document."""
    n_docs = len(off) - 1
    breaks = np.flatnonzero(buf == 10)
    # an empty last line shares its start with the next document's first line; it has no word
    start = np.unique(np.concatenate([off[:-1], breaks + 1]))
    start = start[start < off[-1]]
    doc = np.searchsorted(off, start, side="right") - 1
    stops = np.append(breaks, off[-1])
    end = np.minimum(stops[np.searchsorted(stops, start)], off[doc + 1])
    width = end - start
    data = np.ascontiguousarray(buf[buf != 10])
    o = np.zeros(len(start) + 1, np.int64)
    np.cumsum(width, out=o[1:])
    lines = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(o), pa.py_buffer(data)])
    line = lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    c = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(words.flags, out=c[1:])
    has = c[end] > c[start]
    doc = doc[has]
    distinct = np.unique(doc * (len(lines) + 1) + line[has])
    return (
        np.bincount(doc, minlength=n_docs) - np.bincount(distinct // (len(lines) + 1), minlength=n_docs)
    ).astype(np.int64)


def entropy(doc: np.ndarray, token: np.ndarray, n_docs: int, n_vocab: int) -> np.ndarray:
    """Entropy in bits of each document's token distribution."""
    pair, c = np.unique(doc * n_vocab + token, return_counts=True)
    d = pair // n_vocab
    n = np.bincount(doc, minlength=n_docs).astype(float)
    p = c / n[d]
    return np.bincount(d, weights=-p * np.log2(p), minlength=n_docs) + 0.0


def fallback_share(words: Words, ids: np.ndarray, distinct: pa.Array, pieces, is_byte: np.ndarray) -> np.ndarray:
    """Share of byte pieces among all pieces of each document's words; each distinct word is encoded once."""
    if not len(ids):
        return np.zeros(len(words.count))
    coded = pieces.encode([w.decode("utf-8", "replace") for w in distinct.to_pylist()], num_threads=1)
    width = np.fromiter(map(len, coded), np.int64, len(coded))
    flat = np.fromiter((x for c in coded for x in c), np.int64, int(width.sum()))
    at = np.repeat(np.arange(len(coded)), width)
    n_byte = np.bincount(at, weights=is_byte[flat], minlength=len(coded))
    n_docs = len(words.count)
    every = np.bincount(words.doc, weights=width[ids], minlength=n_docs)
    return np.bincount(words.doc, weights=n_byte[ids], minlength=n_docs) / np.maximum(every, 1)


def measure_slice(texts: pa.Array, ranks, pieces) -> dict[str, np.ndarray]:
    buf, off = text_buffer(texts)
    words, n_docs = Words(buf, off, NON_SPACE), len(off) - 1
    ids, distinct = words.encoded(buf)
    lead = (buf & 0xC0) != 0x80
    coded = [np.array(tokenizers.encode_ordinary(ranks, t or ""), np.int64) for t in texts.to_pylist()]
    n_tokens = np.fromiter(map(len, coded), np.int64, n_docs)
    token = np.concatenate(coded) if n_docs else np.zeros(0, np.int64)
    return {
        "n_words": words.count,
        "word_chars": per_doc(words.flags & lead, off),
        "n_symbols": per_doc(SYMBOL[buf], off),
        "n_dup_lines": duplicate_lines(buf, off, words),
        "n_repeat_words": repeated_words(ids, words),
        "n_tokens": n_tokens,
        "chars_per_token": per_doc(lead, off) / np.maximum(n_tokens, 1),
        "byte_fallback_share": fallback_share(words, ids, distinct, *pieces),
        "token_entropy": entropy(np.repeat(np.arange(n_docs), n_tokens), token, n_docs, ranks.n_vocab),
    }


def measure(docs: DataFrame, folder: str = tokenizers.FOLDER) -> DataFrame:
    """One row of measures per row of ``docs`` (doc_id, lang, text)."""
    spark = docs.sparkSession
    rank_file, piece_file = tokenizers.ship(spark, RANKS, folder), tokenizers.ship(spark, PIECES, folder)

    def run(batches):
        ranks, pieces = tokenizers.rank_encoder(rank_file, RANKS), tokenizers.piece_encoder(piece_file, PIECES)
        for b in slices(batches, "text"):
            out = measure_slice(b.column("text"), ranks, pieces)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("lang"), *map(pa.array, out.values())], ["doc_id", "lang", *out]
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("lang").cast("string"), "text").mapInArrow(run, SCHEMA)


def judge(measures: DataFrame, bands: dict = BANDS) -> DataFrame:
    """Adds base_failed, in_band and kept."""
    low, high, share, bits = (F.lit(x) for x in bands[None])
    for lang, band in bands.items():
        if lang is not None:
            hit = F.col("lang").eqNullSafe(F.lit(lang))
            low, high, share, bits = (
                F.when(hit, F.lit(v)).otherwise(x) for v, x in zip(band, (low, high, share, bits), strict=True)
            )
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    in_band = (
        F.col("chars_per_token").between(low, high)
        & (F.col("byte_fallback_share") <= share)
        & (F.col("token_entropy") >= bits)
    )
    return measures.withColumns({"base_failed": base, "in_band": in_band}).withColumn(
        "kept", ~F.col("base_failed") & F.col("in_band")
    )


def reject(docs: DataFrame, folder: str = tokenizers.FOLDER, bands: dict = BANDS) -> DataFrame:
    """``docs`` without the rows that the rules reject, columns unchanged (one Arrow pass, row by row)."""
    spark = docs.sparkSession
    rank_file, piece_file = tokenizers.ship(spark, RANKS, folder), tokenizers.ship(spark, PIECES, folder)
    at_text, at_lang = docs.columns.index("text"), docs.columns.index("lang")

    def run(batches):
        ranks, pieces = tokenizers.rank_encoder(rank_file, RANKS), tokenizers.piece_encoder(piece_file, PIECES)
        for b in slices(batches, "text"):
            m = measure_slice(b.column(at_text), ranks, pieces)
            band = np.array([bands.get(x, bands[None]) for x in b.column(at_lang).to_pylist()], float).reshape(-1, 4).T
            cpt = m["chars_per_token"]
            bad = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
            good = (band[0] <= cpt) & (cpt <= band[1]) & (m["byte_fallback_share"] <= band[2])
            good &= (m["token_entropy"] >= band[3]) & ~bad
            yield b.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
