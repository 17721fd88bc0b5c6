"""Benchmark decontamination with an FM-index per training shard (operator 9).

The phrases are the distinct windows of ``WINDOW`` consecutive words of the
benchmark items (a shorter item is one window). Inside each Spark task the
documents' words form shards of at most ``SHARD_WORDS``; a shard is indexed
once, all phrases are searched in it backwards together, occurrences are
located by sampled suffix positions, and their spans merged per document. A
shard border overlaps by a window, so a document of any length is covered.

The distinct benchmark items come in blocks of ``BLOCK_BYTES`` of text. One block
is searched in one lazy pass. With more, each is broadcast, searched and released
before the next is collected, so driver and executors hold one block whatever the
size of the benchmark; its hits are stored by row and merged at the end.

Null or empty texts have no words and are clean; null or empty items give no
window; an item with a null id counts under the empty id. Repeated rows: one
result row each. No rows: no result; no items: every document is clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fulfilq.llm.common import ALNUM, LOWER, Words, discard, materialize, slices, text_buffer
from fulfilq.llm.fm_index import FMIndex
from fulfilq.session import scratch_path
from fulfilq.sources.storage import remove

WINDOW = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 << 20

SPANS = "array<struct<start:bigint,end:bigint>>"
MARKS = ["__n_words", "__spans", "__items"]


class Phrases:
    """Distinct windows of some items: symbols per window, and the items that hold each."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        buf, off = text_buffer(pa.array(texts, pa.large_string()))
        buf = LOWER[buf]
        words = Words(buf, off, ALNUM)
        sym, self.vocabulary = words.encoded(buf)
        self.top, self.window, self.ids = len(self.vocabulary), window, ids
        rows, owner, lengths = [], [], []
        for k, n in enumerate(words.count):
            w = sym[words.first[k] : words.first[k + 1]] + 1
            if not n:
                continue
            size = min(int(n), window)
            view = np.zeros((n - size + 1, window), np.int64)
            view[:, :size] = np.lib.stride_tricks.sliding_window_view(w, size)
            rows.append(view)
            owner.append(np.full(len(view), k))
            lengths.append(np.full(len(view), size))
        if not rows:
            self.patterns, self.lengths = np.zeros((0, window), np.int64), np.zeros(0, np.int64)
            self.items, self.items_at = np.zeros(0, np.int64), np.zeros(1, np.int64)
            return
        every, owner = np.concatenate(rows), np.concatenate(owner)
        self.patterns, of = np.unique(every, axis=0, return_inverse=True)
        of = of.reshape(-1)
        self.lengths = (self.patterns > 0).sum(axis=1)
        pair = np.unique(of * len(ids) + owner)
        self.items = pair % len(ids)
        self.items_at = np.searchsorted(pair // len(ids), np.arange(len(self.patterns) + 1))


def word_hits(words: Words, symbols: np.ndarray, p: Phrases, shard_words: int):
    """(hit flag per word, pattern and document of each occurrence) over the documents of a slice."""
    n = len(symbols)
    edges = np.zeros(n + 1, np.int64)
    found, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a in range(0, n, shard_words):
        b = min(n, a + shard_words + p.window - 1)
        # a document end is a symbol of its own: one is put before each document's first word
        doc = words.doc[a:b]
        cut = np.flatnonzero(doc[1:] != doc[:-1]) + 1
        shard = np.insert(symbols[a:b], cut, 0)
        word_at = np.insert(np.arange(a, b), cut, -1)
        index = FMIndex(shard, p.top)
        low, high = index.count(p.patterns, p.lengths)
        size = high - low
        which = np.flatnonzero(size)
        if not len(which):
            continue
        size = size[which]
        row = np.repeat(low[which], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        pattern = np.repeat(which, size)
        start = word_at[index.locate(row)]
        np.add.at(edges, start, 1)
        np.add.at(edges, start + p.lengths[pattern], -1)
        found.append(pattern)
        docs.append(words.doc[start])
    return np.cumsum(edges[:-1]) > 0, np.concatenate(found), np.concatenate(docs)


def search(texts, p: Phrases, shard_words: int):
    """(words, hit flags, [(document, item id)]) of a slice of texts."""
    buf, off = text_buffer(texts)
    low = LOWER[buf]
    words = Words(low, off, ALNUM)
    ids, distinct = words.encoded(low)
    known = np.zeros(len(distinct), np.int64)
    if len(distinct) and p.top:
        at = pa.compute.index_in(distinct, value_set=p.vocabulary.cast(distinct.type))
        known = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    hit, pattern, doc = word_hits(words, known[ids], p, shard_words)
    pair = np.unique(doc * max(1, len(p.patterns)) + pattern)
    doc, pattern = pair // max(1, len(p.patterns)), pair % max(1, len(p.patterns))
    items = sorted({(int(d), p.ids[i]) for d, w in zip(doc, pattern, strict=True) for i in p.items[p.items_at[w] : p.items_at[w + 1]]})
    return buf, off, words, hit, items


def block_count(benchmark: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """(the distinct items with text, number of blocks they are cut into)."""
    b = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    b = b.where(F.length("text") > 0).distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return b, max(1, -(-total // block_bytes))


def block(items: DataFrame, k: int, n: int, window: int):
    """Broadcast of the phrases of block k of n: a block of items is all that the driver holds."""
    part = items if n == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
    rows = part.orderBy("id", "text").collect()
    return items.sparkSession.sparkContext.broadcast(Phrases([r["id"] for r in rows], [r["text"] for r in rows], window))


def hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Adds to the rows of ``docs`` (must have text): __n_words, __spans (words, end exclusive, merged), __items."""
    items, n = block_count(benchmark, block_bytes)
    if n == 1:
        return hits_of_block(docs, block(items, 0, 1, window), shard_words)
    return hits_of_blocks(docs, items, n, window, shard_words)


def hits_of_block(docs: DataFrame, shared, shard_words: int) -> DataFrame:
    names = docs.columns

    def run(batches):
        p = shared.value
        for b in slices(batches, "text"):
            _, _, words, hit, found = search(b.column("text"), p, shard_words)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(words.count), span_column(words, hit), item_column(found, b.num_rows)],
                [*names, *MARKS],
            )

    return docs.mapInArrow(run, marked_schema(docs))


def hits_of_blocks(docs: DataFrame, items: DataFrame, n: int, window: int, shard_words: int) -> DataFrame:
    """As ``hits``, one pass per block: what a block hits is written, and its broadcast released, before the next.

    Only hit rows are written, by a row number of the stored documents, so a
    pass costs reading the texts; the merged spans meet their rows in one join.
    """
    spark = docs.sparkSession
    names = docs.columns
    stored = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "fm-documents")
    path = scratch_path(spark, "fm-hits")
    for k in range(n):
        shared = block(items, k, n, window)

        def run(batches, shared=shared):
            for b in slices(batches, "text"):
                _, _, words, hit, found = search(b.column("text"), shared.value, shard_words)
                spans = span_column(words, hit)
                some = pa.compute.greater(pa.compute.list_value_length(spans), 0)
                every = [b.column("__row"), spans, item_column(found, b.num_rows)]
                yield pa.RecordBatch.from_arrays(every, ["__row", "__spans", "__items"]).filter(some)

        part = stored.select("__row", "text").mapInArrow(run, f"__row bigint, __spans {SPANS}, __items array<string>")
        part.write.mode("append").parquet(path)
        shared.destroy()
    parts = spark.read.schema(part.schema).parquet(path)
    of_row = parts.groupBy("__row").agg(
        F.flatten(F.collect_list("__spans")).alias("__spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__items")))).alias("__items"),
    )

    def merge(batches):
        for b in slices(batches, "text"):
            buf, off = text_buffer(b.column("text"))
            words = Words(buf, off, ALNUM)
            edges = np.zeros(len(words.doc) + 1, np.int64)
            for first, spans in zip(words.first, b.column("__spans").to_pylist(), strict=False):
                for s in spans or ():
                    edges[first + s["start"]] += 1
                    edges[first + s["end"]] -= 1
            found = [x or [] for x in b.column("__items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(c) for c in names),
                    pa.array(words.count),
                    span_column(words, np.cumsum(edges[:-1]) > 0),
                    pa.array(found, pa.list_(pa.string())),
                ],
                [*names, *MARKS],
            )

    out = stored.join(of_row, "__row", "left").select(*names, "__spans", "__items").mapInArrow(merge, marked_schema(docs))
    out._reads = [stored._scratch, path]  # tables that the lazy result reads
    return out


def marked_schema(docs: DataFrame) -> T.StructType:
    extra = f"__n_words bigint, __spans {SPANS}, __items array<string>"
    return T.StructType(docs.schema.fields + T._parse_datatype_string(extra).fields)


def item_column(found: list[tuple[int, str]], rows: int) -> pa.Array:
    """The sorted ids of each document of a slice, from sorted (document, item id)."""
    out = [[] for _ in range(rows)]
    for d, i in found:
        out[d].append(i)
    return pa.array(out, pa.list_(pa.string()))


def runs(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word, end word) of the merged runs of hit words, word numbers over the slice."""
    n = len(hit)
    fresh = np.ones(n, bool)
    fresh[1:] = words.doc[1:] != words.doc[:-1]
    before = np.zeros(n, bool)
    before[1:] = hit[:-1]
    after = np.zeros(n, bool)
    after[:-1] = hit[1:]
    last = np.append(fresh[1:], True) if n else fresh
    start = np.flatnonzero(hit & (fresh | ~before))
    end = np.flatnonzero(hit & (last | ~after)) + 1
    return words.doc[start], start, end


def span_column(words: Words, hit: np.ndarray) -> pa.Array:
    doc, start, end = runs(words, hit)
    base = words.first[doc]
    n = np.bincount(doc, minlength=len(words.count))
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(start - base), pa.array(end - base)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(off), pairs)


def cut(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with every occurrence of a benchmark window cut out of the texts, columns unchanged.

    A cut leaves a line break. Texts are searched again until none is left (a
    cut can bring words together); a document without words left goes. n_chars,
    where there is one, follows the text. With one block of phrases a text is
    searched again where it is; with more, the changed texts are searched again
    together, block by block, and the result is a stored table. Both give the same rows.
    """
    items, n = block_count(benchmark, block_bytes)
    if n == 1:
        shared = block(items, 0, 1, window)
        return cut_marked(docs, docs, shared, shard_words).drop("__again")
    spark = docs.sparkSession
    path, left, last = scratch_path(spark, "fm-cut"), docs, None
    while True:
        marked = hits_of_blocks(left, items, n, window, shard_words)
        now = materialize(cut_marked(marked, docs, None, shard_words), "fm-round")
        for used in marked._reads if last is None else [*marked._reads, last._scratch]:
            remove(spark, used)
        now.where("not __again").drop("__again").write.mode("append").parquet(path)
        left, last = now.where("__again").drop("__again"), now
        if left.isEmpty():
            discard(now)
            return spark.read.schema(docs.schema).parquet(path)


def cut_marked(marked: DataFrame, docs: DataFrame, shared, shard_words: int) -> DataFrame:
    """Rows of ``marked`` (see ``hits``) with their spans cut out, and ``__again``: the text must be searched again.

    With the broadcast phrases ``shared`` the rows need no spans: one Python pass
    searches a text, cuts it and searches it again until nothing is left.
    """
    names = docs.columns

    def run(batches):
        for b in slices(batches, "text"):
            old = b.column("text").to_pylist()
            if shared is None:
                buf, off = text_buffer(b.column("text"))
                words, found = Words(LOWER[buf], off, ALNUM), b.column("__spans")
            else:
                buf, off, words, hit, _ = search(b.column("text"), shared.value, shard_words)
                found = span_column(words, hit)
            new, keep, more = list(old), np.ones(len(old), bool), np.zeros(len(old), bool)
            for d, spans in enumerate(found.to_pylist()):
                if not spans:
                    continue
                data, at = bytes(buf[off[d] : off[d + 1]]), words.first[d]
                places = [(words.start[at + s["start"]] - off[d], words.end[at + s["end"] - 1] - off[d]) for s in spans]
                text = without(data, places)
                while shared is not None:
                    raw, _, w, hit, _ = search(pa.array([text.decode()], pa.large_string()), shared.value, shard_words)
                    _, s, e = runs(w, hit)
                    if not len(s):
                        break
                    text = without(bytes(raw), list(zip(w.start[s], w.end[e - 1], strict=True)))
                new[d], more[d] = text.decode(), shared is None
                keep[d] = bool(ALNUM[np.frombuffer(text, np.uint8)].any())
            cols = {c: b.column(c) for c in names}
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                sizes = [len(t) if t is not o else n for t, o, n in zip(new, old, cols["n_chars"].to_pylist(), strict=True)]
                cols["n_chars"] = pa.array(sizes, cols["n_chars"].type)
            cols["__again"] = pa.array(more)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols)).filter(pa.array(keep))

    return marked.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__again", T.BooleanType())]))


def without(data: bytes, places: list[tuple[int, int]]) -> bytes:
    if not places:
        return data
    parts, at = [], 0
    for start, end in places:
        parts.append(data[at:start])
        at = end
    return b"\n".join([*parts, data[at:]]).strip(b"\n") if at else data
