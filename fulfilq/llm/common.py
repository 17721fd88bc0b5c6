"""Shared helpers: Arrow text buffers, vectorised word splitting, shared scratch tables.

A word table is computed with numpy over the UTF-8 bytes of many documents at
once: classes are byte lookups, word borders are class changes or document
borders. Nothing here looks at less than a whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulfilq.llm import reach_workers
from fulfilq.session import scratch_path
from fulfilq.sources.storage import remove

#: ASCII white space, [\x20\x09-\x0D].
SPACE = bytes([32, 9, 10, 11, 12, 13])
#: Byte is part of a word ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.array([b not in SPACE for b in range(256)])
#: Byte is part of a word ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: A-Z to a-z, other bytes as they are.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
LOWER_BYTES = bytes(LOWER)

#: Text handled at once inside a task; a longer single document is handled alone.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers()
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``materialize`` that no later step reads."""
    for t in tables:
        remove(t.sparkSession, t._scratch)


def flat(arr) -> pa.Array:
    return arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr


def text_buffer(arr) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    arr = flat(arr)
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if not (pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) or pa.types.is_binary(arr.type)):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_binary(arr.type) else "")
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    _, off, data = arr.buffers()
    off = np.frombuffer(off, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text (one document at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(column))
        i = 0
        while i < batch.num_rows:
            j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
            j = min(max(j, i + 1), batch.num_rows)
            yield batch.slice(i, j - i)
            i = j


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a byte-wise array over each document."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


class Words:
    """Words of many documents: byte ``start`` and ``end``, ``doc`` of each, ``count`` by document."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, in_word: np.ndarray):
        n = len(buf)
        self.flags = w = in_word[buf]
        border = np.zeros(n + 1, bool)
        border[off] = True
        before = np.zeros(n, bool)
        after = np.zeros(n, bool)
        before[1:] = w[:-1]
        after[:-1] = w[1:]
        self.start = np.flatnonzero(w & (border[:n] | ~before))
        self.end = np.flatnonzero(w & (border[1:] | ~after)) + 1
        self.doc = np.searchsorted(off, self.start, side="right") - 1
        self.count = np.bincount(self.doc, minlength=len(off) - 1).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])

    def values(self, buf: np.ndarray) -> pa.Array:
        """The words as an Arrow array. ``buf``: the bytes, e.g. lower-cased."""
        off = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.end - self.start, out=off[1:])
        data = buf[self.flags]
        kind, width = (pa.binary(), np.int32) if off[-1] < 2**31 else (pa.large_binary(), np.int64)
        return pa.Array.from_buffers(
            kind, len(self.start), [None, pa.py_buffer(off.astype(width)), pa.py_buffer(np.ascontiguousarray(data))]
        )

    def encoded(self, buf: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """(id of each word, the distinct words): ids are exact within these documents."""
        d = self.values(buf).dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_lower(col):
    """A-Z lower-cased, nothing else (JVM side)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
