"""Near-duplicate classes by DartMinHash (operator 3).

A document is the weighted set of its five-word shingles (weight: how often a
shingle occurs). Darts are thrown into each element's plane of weight and rank
by hashing: the plane is cut into cells of weight 1 and rank 1, each cell holds
a hashed Poisson(1) number of darts with hashed rank and coordinate. A document
sees the darts below its weights and below the rank theta = t / total weight,
about t of them however long it is, and keeps the earliest per coordinate.
Equal coordinates have the probability of the weighted Jaccard similarity;
where a coordinate stayed empty, t is doubled for that document.

Exact copies are one node (digest of the text) from the start. Bands of the
signature join nodes into buckets. A bucket is never expanded into its pairs.
First its members are compared with its hub, the node that shares most buckets
with others; links make components by label propagation. Then, in buckets that
still hold several components, the members outside the hub's are compared with
those of other components, where two bounds leave a chance: the triangle
inequality of the Jaccard distance over the hub (exact), and a longer one-bit
signature whose estimate is less than three standard deviations below the
threshold. A bucket's comparisons are dealt over tasks by blocks of its members. Each comparison is exact (weighted Jaccard of the shingle sets,
``SIMILARITY`` or more). A pair of texts at the very threshold is missed with a
probability of 0.002 by the bands and of 0.001 by the estimate, a closer one
with less.

All state is written to the shared checkpoint folder between steps. Texts of
1-4 words are one shingle. A text without words, or empty, has exact copies
only; a null text is a class of its own. A null doc_id sorts before others. The
class id is the least doc_id of the class. Repeated rows share a class. No
rows: no result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import ALNUM, LOWER, Words, discard, materialize, mix64, slices, text_buffer

SHINGLE = 5
SIMILARITY = 0.8
#: Coordinates of the signature; a power of two, as the coordinate is the low bits of a dart's hash.
COORDINATES = 128
BANDS, ROWS = 21, 6
#: Coordinates of the one-bit signature that estimates a pair's similarity, and the most differing bits of a candidate.
BITS = 1024
MOST_BITS = int(BITS / 2 * (1 - SIMILARITY) + 3 * np.sqrt(BITS * (1 - SIMILARITY) / 2 * (1 + SIMILARITY) / 2))
#: Pairs of a bucket that one task looks at, about, and the most parts of a bucket.
TASK_PAIRS, MOST_PARTS = 1 << 22, 1 << 14
#: Shingle sets that a comparing task holds, in bytes, about.
BLOCK_BYTES = 8 << 20
SLICE = 2 << 20

GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Poisson(1) distribution function over 64-bit hashes.
_p = np.exp(-1) / np.cumprod(np.concatenate([[1.0], np.arange(1.0, 20)]))
POISSON = (np.minimum(np.cumsum(_p), 1 - 2**-53) * 2.0**64).astype(np.uint64)


def shingle_sets(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, 64-bit shingle, weight) sorted by document and shingle, and total weight by document."""
    buf, off = text_buffer(texts)
    low = LOWER[buf]
    words = Words(low, off, ALNUM)
    ids, distinct = words.encoded(low)
    n_docs = len(off) - 1
    coded = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    w = coded[ids] if len(ids) else np.zeros(0, np.uint64)
    n = len(w) - SHINGLE + 1
    doc, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n > 0:
        at = np.flatnonzero(words.doc[:n] == words.doc[SHINGLE - 1 :])
        h = np.full(len(at), SHINGLE, np.uint64)
        for j in range(SHINGLE):
            h = mix64(h * GOLD + w[at + j])
        doc = words.doc[at]
    short = np.flatnonzero((words.count > 0) & (words.count < SHINGLE))
    if len(short):
        hs = words.count[short].astype(np.uint64)
        for j in range(SHINGLE - 1):
            has = words.count[short] > j
            hs[has] = mix64(hs[has] * GOLD + w[words.first[short[has]] + j])
        doc, h = np.concatenate([doc, short]), np.concatenate([h, hs])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(h)))
    return doc[first], h[first], weight, np.bincount(doc, minlength=n_docs)


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, total: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """Rank of the earliest dart per document and coordinate; inf where a document has no element."""
    sig = np.full((len(total), k), np.inf)
    darts = k * (np.log(k) + 3)
    # one strip of weight 1 per occurrence of an element
    strip_doc = np.repeat(doc, weight)
    nth = np.arange(len(strip_doc)) - np.repeat(np.cumsum(weight) - weight, weight)
    strip = mix64(np.repeat(h, weight) + nth.astype(np.uint64) * GOLD)
    while len(strip):
        theta = darts / total
        cells = np.ceil(theta[strip_doc]).astype(np.int64)
        cell = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
        seed = mix64(np.repeat(strip, cells) ^ mix64(cell.astype(np.uint64) + GOLD))
        n = np.searchsorted(POISSON, seed, side="right")
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        dart = mix64(np.repeat(seed, n) + (nth.astype(np.uint64) + np.uint64(1)) * GOLD)
        d = np.repeat(np.repeat(strip_doc, cells), n)
        rank = np.repeat(cell, n) + (dart >> np.uint64(11)).astype(np.float64) * 2.0**-53
        seen = rank < theta[d]
        coordinate = (dart[seen] & np.uint64(k - 1)).astype(np.int64)
        np.minimum.at(sig.reshape(-1), d[seen] * k + coordinate, rank[seen])
        gap = np.isinf(sig).any(axis=1)
        again = gap[strip_doc]
        strip, strip_doc, darts = strip[again], strip_doc[again], darts * 2
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per document and band."""
    bits = sig.view(np.uint64)
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(sig), b + 1, np.uint64)
        for r in range(ROWS):
            key = mix64(key * GOLD + bits[:, b * ROWS + r])
        out[:, b] = key
    return out.view(np.int64)


def sign_batches(batches):
    for b in slices(batches, "text", SLICE):
        with np.errstate(divide="ignore"):
            doc, h, weight, total = shingle_sets(b.column("text"))
            keys = band_keys(signatures(doc, h, weight, total))
        some = total > 0
        off = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(off), pa.array(keys[some].reshape(-1)))
        yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("node"), lists], ["doc", "node", "bands"])


def set_batches(batches):
    """The shingle set of each text (sorted 64-bit shingles and their weights, as bytes) and its one-bit signature."""
    for b in slices(batches, "text", SLICE // 4):
        doc, h, weight, total = shingle_sets(b.column("text"))
        with np.errstate(divide="ignore"):
            ranks = signatures(doc, h, weight, total, BITS).view(np.uint64)
        bits = np.packbits((mix64(ranks) & np.uint64(1)).astype(bool), axis=1).view(np.int64)
        at = np.searchsorted(doc, np.arange(len(total) + 1))
        sets = [
            h[i:j].tobytes() + weight[i:j].astype(np.uint32).tobytes() for i, j in zip(at[:-1], at[1:], strict=True)
        ]
        longs = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * (BITS // 64)), pa.array(bits.reshape(-1)))
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sets, pa.binary()), longs], ["node", "elements", "bits"])


def similarity(x: bytes, y: bytes) -> float:
    """Weighted Jaccard similarity of two shingle sets."""

    def parts(s):
        n = len(s) // 12
        return np.frombuffer(s, np.uint64, n), np.frombuffer(s, np.uint32, n, n * 8).astype(np.int64)

    (hx, wx), (hy, wy) = parts(x), parts(y)
    if not len(hx) or not len(hy):
        return 0.0
    at = np.minimum(np.searchsorted(hy, hx), len(hy) - 1)
    both = hy[at] == hx
    common = int(np.minimum(wx[both], wy[at[both]]).sum())
    return common / (int(wx.sum()) + int(wy.sum()) - common)


def compare_group(pairs, sets):
    """Similarities of a group's pairs; ``sets`` has their nodes' shingle sets."""
    of = dict(zip(sets["node"].map(bytes), sets["elements"], strict=True))
    like = [similarity(of[bytes(a)], of[bytes(b)]) for a, b in zip(pairs["a"], pairs["b"], strict=True)]
    return pd.DataFrame({"a": pairs["a"], "b": pairs["b"], "similarity": like})


def compared(pairs: DataFrame, sets: DataFrame, blocks: int, name: str) -> DataFrame:
    """Table of (a, b, similarity) of every pair (a, b), exactly.

    Nodes fall into ``blocks`` by hash; a group is a pair of blocks, and a node's
    set travels once to each group that needs it, however many of its pairs are there.
    """

    def block(c):
        return F.pmod(F.xxhash64(c), F.lit(blocks))

    p = materialize(pairs.select("a", "b", block("a").alias("ga"), block("b").alias("gb")), "dart-pairs")
    group = [F.col("ga").alias("ha"), F.col("gb").alias("hb")]
    wanted = p.select(*group, F.col("a").alias("node")).unionByName(p.select(*group, F.col("b").alias("node")))
    held = wanted.distinct().join(sets.select("node", "elements"), "node")
    both = p.groupBy("ga", "gb").cogroup(held.groupBy("ha", "hb"))
    out = materialize(both.applyInPandas(compare_group, "a binary, b binary, similarity double"), name)
    discard(p)
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc, node (128 bits of the text's digest; null text: null), text."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc"),
        F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)).alias("node"),
        F.col("text"),
    )


def components(links: DataFrame, start: DataFrame | None) -> DataFrame:
    """(node, comp) of the nodes with links: least node of each component, by label propagation."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "dart-edges")
    label = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("comp"))
    if start is not None:
        old = start.withColumnRenamed("comp", "old")
        label = label.join(old, "node", "left").select("node", F.least("comp", "old").alias("comp"))
    label = materialize(label, "dart-labels")
    while True:
        near = both.join(label.withColumnsRenamed({"node": "b", "comp": "c"}), "b").groupBy("a").agg(F.min("c").alias("c"))
        new = label.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "c").alias("next")
        )
        jump = label.withColumnsRenamed({"node": "next", "comp": "after"})
        new = new.join(jump, "next").select("node", "was", F.least("next", "after").alias("comp"))
        new, old = materialize(new, "dart-labels"), label
        moved = not new.where(F.col("was") != F.col("comp")).isEmpty()
        discard(old)
        label = new.select("node", "comp")
        label._scratch = new._scratch
        if not moved:
            discard(both)
            return label


def classes(docs: DataFrame) -> DataFrame:
    """(doc, node, class_id, class_size, lead) per row of ``docs`` (doc_id, text); ``lead``: the node that stays.

    A null text has a null node and class of its own.
    """
    all_docs = keyed(docs)
    texts = all_docs.where(F.col("text").isNotNull())
    signed = materialize(texts.mapInArrow(sign_batches, "doc bigint, node binary, bands array<bigint>"), "dart-signed")
    nodes = signed.groupBy("node").agg(
        F.min("doc").alias("doc"), F.count("*").alias("n"), F.first("bands").alias("bands")
    )
    nodes = materialize(nodes, "dart-nodes")
    in_bucket = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = in_bucket.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    in_buckets = materialize(in_bucket.join(shared, "bucket"), "dart-members")
    score = in_buckets.groupBy("node").agg((-F.sum("n")).alias("least"))
    ranked = in_buckets.join(score, "node")
    hub = ranked.groupBy("bucket").agg(F.min(F.struct("least", F.xxhash64("node").alias("o"), "node"))["node"].alias("hub"))
    members = materialize(in_buckets.join(hub, "bucket"), "dart-hubs")
    discard(in_buckets)
    needed = members.select("node").distinct().join(nodes, "node").select(F.col("doc").alias("d"), F.col("node").alias("k"))
    mine = F.col("doc").eqNullSafe(F.col("d")) & (F.col("node") == F.col("k"))
    sets = texts.join(needed, mine, "left_semi").mapInArrow(set_batches, "node binary, elements binary, bits array<bigint>")
    sets = materialize(sets.dropDuplicates(["node"]), "dart-sets")
    size = sets.agg(F.sum(F.length("elements"))).first()[0] or 0
    blocks = max(8, -(-size // BLOCK_BYTES))

    def pair(x, y):
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    spokes = members.where("node != hub").select(*pair("node", "hub")).distinct()
    spokes = compared(spokes, sets, blocks, "dart-spokes")
    links = spokes.where(F.col("similarity") >= SIMILARITY).select("a", "b")
    comp = components(links, None)

    # buckets of several components, with each member's similarity to the hub and its bits
    m = members.where("n > 2").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    split = m.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi")
    m = m.join(split.select("bucket"), "bucket", "left_semi")
    m = m.withColumns(dict(zip(("a", "b"), pair("node", "hub"), strict=True))).join(spokes, ["a", "b"], "left")
    near = F.coalesce("similarity", F.lit(1.0)).alias("near")  # the hub itself
    of_hub = comp.select(F.col("node").alias("hub"), F.col("comp").alias("hub_comp"))
    m = m.select("bucket", "node", "hub", "comp", near).join(of_hub, "hub", "left")
    outside = F.col("comp") != F.coalesce("hub_comp", "hub")
    in_open = m.withColumn("outside", outside).join(sets.select("node", "bits"), "node").drop("hub", "hub_comp")
    m = materialize(in_open, "dart-open")
    # a bucket of many members is cut into parts: a member outside is in one of them, all members are in each
    count = m.groupBy("bucket").agg(F.count("*").alias("all"), F.count_if("outside").alias("out"))
    parts = F.least(F.greatest(F.ceil(F.col("all") * F.col("out") / TASK_PAIRS), F.lit(1)), F.col("out"), F.lit(MOST_PARTS))
    dealt = m.join(count.select("bucket", parts.cast("int").alias("parts")), "bucket")
    x = dealt.where("outside").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).alias("x")
    y = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    differ = sum(
        (F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(BITS // 64)), F.lit(0)
    )
    # of two members outside one is x; a hub's distance to both bounds theirs: 1 - similarity is a metric
    rest = (
        (F.col("x.bucket") == F.col("y.bucket"))
        & (F.col("x.part") == F.col("y.part"))
        & (F.col("x.comp") != F.col("y.comp"))
        & (~F.col("y.outside") | (F.col("x.node") < F.col("y.node")))
        & (F.abs(F.col("x.near") - F.col("y.near")) <= 1 - SIMILARITY + 1e-9)
        & (differ <= MOST_BITS)
    )
    rest = x.join(y, rest).select(*pair(F.col("x.node"), F.col("y.node"))).distinct()
    rest = rest.join(spokes.select("a", "b"), ["a", "b"], "left_anti")
    rest = compared(rest, sets, blocks, "dart-rest")
    found = rest.where(F.col("similarity") >= SIMILARITY)
    if not found.isEmpty():
        comp, old = components(links.unionByName(found.select("a", "b")), comp), comp
        discard(old)
    discard(members, sets, spokes, m, rest)
    label = nodes.select("node", "doc", "n").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    per_class = label.groupBy("comp").agg(
        F.min(F.struct("doc", "node")).alias("lead"), F.sum("n").alias("class_size")
    )
    of_node = materialize(
        label.select("node", "comp").join(per_class, "comp").select(
            F.col("node").alias("k"), F.col("lead.doc").alias("class_id"), "class_size", F.col("lead.node").alias("lead")
        ),
        "dart-classes",
    )
    discard(nodes, comp)
    rows = signed.select("doc", "node").join(of_node, F.col("node") == F.col("k")).drop("k")
    alone = all_docs.where(F.col("text").isNull()).select(
        "doc", "node", F.col("doc").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), F.col("node").alias("lead")
    )
    return rows.unionByName(alone)


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, that of the class id; columns unchanged. Null texts stay."""
    names = docs.columns
    lead = classes(docs).where(F.col("lead").isNotNull()).select(F.col("class_id").alias("__id"), F.col("lead").alias("__lead"))
    lead = lead.distinct()
    d = docs.withColumn("__node", F.unhex(F.substring(F.sha2(F.col("text").cast("binary"), 256), 1, 32)))
    same = (F.col("__node") == F.col("__lead")) & F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id"))
    kept = d.join(lead, same, "left_semi").dropDuplicates(["__node"])
    return kept.select(*names).unionByName(docs.where(F.col("text").isNull()))
