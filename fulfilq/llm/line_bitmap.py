"""Line dedup by range-partitioned hashes (operator 10).

Every line's key (ends stripped, A-Z lower-cased, ten code points at least) is
hashed to 128 bits. The records (hash, document, row, position) are
range-partitioned and sorted; each partition streams its run of equal hashes
once: the first document of a run keeps its lines, later ones lose theirs. A
run can go over partition borders (a hot line is dealt over many), so every
partition reports where its first and its last run begin and hands the rows of
its first run on as pending; they are settled against those reports, of which
there are two per partition. The result is a zlib-compressed keep bitmap per document,
no text.

Rows with the same doc_id and text are the same document. Null or empty text:
one empty line, kept. A null doc_id counts as one document after all others.
Repeated rows: one bitmap, applied to each of them.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import LOWER_BYTES, SPACE, materialize, slices

LEAST = 10
#: Stands for a null doc_id: after all others.
LAST_ID = 2**63 - 1


def keyed(docs: DataFrame) -> DataFrame:
    """doc (id, null last), row (fingerprint of the text), text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def line_keys(batches):
    for b in slices(batches, "text"):
        at, pos, hashes = [], [], []
        for i, text in enumerate(b.column("text").to_pylist()):
            for j, line in enumerate(text.encode().split(b"\n")):
                key = line.strip(SPACE)
                if len(key) >= LEAST and (key.isascii() or len(key.decode()) >= LEAST):
                    at.append(i)
                    pos.append(j)
                    hashes.append(xxhash.xxh3_128_digest(key.translate(LOWER_BYTES)))
        at = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(hashes, pa.binary()), b.column("doc").take(at), b.column("row").take(at), pa.array(pos, pa.int32())],
            ["h", "doc", "row", "pos"],
        )


DROP, PENDING, BORDER = 0, 1, 2
FIELDS = ["kind", "h", "doc", "row", "pos"]


def stream_runs(batches):
    """Dropped lines of the runs that begin here; the first run's rows as pending; where the first and last run begin."""
    first_hash = run_hash = None
    first_doc = run_doc = 0
    in_first = True
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        hashes = b.column("h").to_pylist()
        doc = b.column("doc").to_numpy(zero_copy_only=False)
        if first_hash is None:
            first_hash = run_hash = hashes[0]
            first_doc = run_doc = int(doc[0])
        starts = np.fromiter((i for i in range(n) if hashes[i] != (hashes[i - 1] if i else run_hash)), np.int64)
        of = np.searchsorted(starts, np.arange(n), side="right") - 1  # -1: the run that came in
        lead = np.where(of >= 0, doc[starts[of]] if len(starts) else run_doc, run_doc)
        pending = (of < 0) if in_first else np.zeros(n, bool)
        kind = np.where(pending, PENDING, DROP).astype(np.int32)
        take = np.flatnonzero(pending | (doc > lead))
        if len(starts):
            in_first, run_hash, run_doc = False, hashes[starts[-1]], int(doc[starts[-1]])
        if len(take):
            t = pa.array(take)
            yield pa.RecordBatch.from_arrays([pa.array(kind[take]), *(b.column(c).take(t) for c in FIELDS[1:])], FIELDS)
    if run_hash is not None:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([BORDER] * 2, pa.int32()),
                pa.array([first_hash, run_hash], pa.binary()),
                pa.array([first_doc, run_doc], pa.int64()),
                pa.array([0, 0], pa.int64()),
                pa.array([0, 0], pa.int32()),
            ],
            FIELDS,
        )


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc, row, pos) of every line that an earlier document holds."""
    lines = keyed(docs).mapInArrow(line_keys, "h binary, doc bigint, row bigint, pos int")
    order = ["h", "doc", "row", "pos"]
    runs = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    out = materialize(runs.mapInArrow(stream_runs, "kind int, h binary, doc bigint, row bigint, pos int"), "line-runs")
    pending = out.where(F.col("kind") == PENDING)
    # two border rows per partition, so this side is bounded by the partition count
    lead = out.where(F.col("kind") == BORDER).groupBy("h").agg(F.min("doc").alias("lead"))
    late = pending.join(F.broadcast(lead), "h").where(F.col("doc") > F.col("lead"))
    return out.where(F.col("kind") == DROP).select("doc", "row", "pos").unionByName(late.select("doc", "row", "pos"))


def pack(n_lines: int, dropped) -> bytes:
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def pack_batches(batches):
    for b in batches:
        n = b.column("n_lines").to_pylist()
        gone = [np.unique(np.array(x or [], np.int64)) for x in b.column("gone").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                b.column("doc"),
                b.column("row"),
                b.column("n_lines"),
                pa.array(map(len, gone), pa.int64()),
                pa.array([pack(k, g) for k, g in zip(n, gone, strict=True)], pa.binary()),
            ],
            ["doc", "row", "n_lines", "n_dropped", "keep"],
        )


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc, row, n_lines, n_dropped, keep) per distinct document; ``keep`` is a compressed bitmap, a bit per line."""
    gone = dropped_lines(docs).groupBy("doc", "row").agg(F.collect_list("pos").alias("gone"))
    k = keyed(docs)
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    heads = k.groupBy("doc", "row").agg(F.max(n_lines).cast("bigint").alias("n_lines"))
    return heads.join(gone, ["doc", "row"], "left").mapInArrow(
        pack_batches, "doc bigint, row bigint, n_lines bigint, n_dropped bigint, keep binary"
    )


def kept_text(text: str, keep: bytes, n_lines: int) -> str:
    lines = text.split("\n")
    mask = unpack(keep, n_lines)
    return text if mask.all() else "\n".join(x for x, k in zip(lines, mask, strict=True) if k)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, run, schema) -> DataFrame:
    """``run`` over the rows of ``docs`` with their bitmap in columns ``__n_lines``, ``__n_dropped``, ``__keep``."""
    b = bitmaps.select(
        F.col("doc").alias("__doc"),
        F.col("row").alias("__row"),
        F.col("n_lines").alias("__n_lines"),
        F.col("n_dropped").alias("__n_dropped"),
        F.col("keep").alias("__keep"),
    )
    d = docs.withColumns(
        {
            "__doc": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST_ID)),
            "__row": F.xxhash64(F.coalesce("text", F.lit(""))),
        }
    )
    return d.join(b.hint("shuffle_hash"), ["__doc", "__row"]).mapInArrow(run, schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text; n_chars, where there is one, follows the text."""
    names, schema = docs.columns, docs.schema

    def run(batches):
        for b in slices(batches, "text"):
            cols = {c: b.column(c) for c in names}
            old = cols["text"].to_pylist()
            keep, n = b.column("__keep").to_pylist(), b.column("__n_lines").to_pylist()
            gone = b.column("__n_dropped").to_pylist()
            new = [kept_text(t, k, m) if g else t for t, k, m, g in zip(old, keep, n, gone, strict=True)]
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                size = [len(t) if g else c for t, c, g in zip(new, cols["n_chars"].to_pylist(), gone, strict=True)]
                cols["n_chars"] = pa.array(size, cols["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return apply_bitmaps(docs, keep_bitmaps(docs), run, schema)
