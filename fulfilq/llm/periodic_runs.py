"""Periodic runs of words by grammar compression (operator 11).

A run is a stretch of words with smallest period q, at least ``MIN_LENGTH`` words
and ``MIN_EXPONENT`` periods long, that neither neighbour extends. Within a task
the documents of one slice are searched together:

1. Every window of 8 words inside a run occurs twice or more in its document, so
   only stretches of words in such windows are looked at (a lossless filter).
2. Re-Pair on the word ids: the most frequent pair becomes a nonterminal, and so
   on until no pair is left twice. One round takes, beside the most frequent pair,
   every pair that no more frequent one overlaps (those replacements do not
   disturb each other). What is left of a stretch is joined by a balanced tree.
3. A run crosses the boundary between the two halves of some node that holds it
   whole. For each nonterminal the runs across its boundary are computed once:
   their periods are distances to other places of the two words at the boundary,
   their extents come from common-extension queries on rolling hashes. Each run
   is then compared word by word; a collision starts over with other hashes.
4. Runs are translated to all places of their nonterminal in the derivation, and
   pieces of one period that overlap by a period are merged.

One Arrow pass, no shuffle; memory grows with a slice of text or one document.
Null or empty text: no words, no runs. Repeated rows: one result each. Other
columns of ``docs`` are neither read nor returned by ``find``; ``collapse`` keeps them.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import NON_SPACE, Words, mix64, slices, text_buffer

MIN_LENGTH, MIN_EXPONENT, WINDOW = 24, 3, 8
#: Modulus of the rolling hashes, and places looked at together.
PRIME, CHUNK = 2**31 - 1, 1 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def in_repeats(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words in a window of 8 that occurs twice or more in its document (by a 64-bit hash: some more at worst)."""
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(ids), bool)
    h = doc[:n].astype(np.uint64)
    for j in range(WINDOW):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + ids[j : n + j].astype(np.uint64) + np.uint64(1))
    inside = np.flatnonzero(doc[:n] == doc[WINDOW - 1 :])
    order = inside[np.argsort(h[inside])]
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[order[twice]] += 1
    cover[WINDOW:] -= np.bincount(order[twice], minlength=n)
    return np.cumsum(cover[:-1]) > 0


def grammar(words: np.ndarray, part: np.ndarray) -> dict[str, np.ndarray]:
    """Every inner node of the derivation trees: its ``rule``, ``start``, size of the ``left`` half and ``size``.

    ``part`` numbers the stretches; no pair crosses two of them.
    """
    sym = np.unique(words, return_inverse=True)[1].astype(np.int64)
    start, size, part = np.arange(len(sym)), np.ones(len(sym), np.int64), part.astype(np.int64)
    fresh, rules, nodes = len(sym), {}, []

    def replace(at, new):
        nonlocal sym, start, size, part
        nodes.append((new, start[at], size[at], size[at] + size[at + 1]))
        sym[at] = new
        size[at] += size[at + 1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        sym, start, size, part = sym[keep], start[keep], size[keep], part[keep]

    while len(sym) > 1:
        key = np.where(part[1:] == part[:-1], (sym[:-1] << 32) | sym[1:], -1 - np.arange(len(sym) - 1))
        pairs, which, count = np.unique(key, return_inverse=True, return_counts=True)
        count[pairs < 0] = 0
        if count.max() < 2:
            break
        # falling frequency; equal ones in an order that does not follow the text
        rank = np.empty(len(pairs), np.int64)
        rank[np.lexsort((mix64(pairs.astype(np.uint64)), count))] = np.arange(len(pairs))
        rank[count < 2] = -1
        p = np.concatenate([[-1], rank[which], [-1]])
        # places of one pair side by side (a word repeated): every other one, from the first
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        last = np.append(first[1:], len(key)) - 1
        peak = (p[first + 1] >= 0) & (p[first] < p[first + 1]) & (p[last + 2] < p[first + 1])
        group = np.repeat(np.arange(len(first)), last - first + 1)
        at = np.flatnonzero(peak[group] & ((np.arange(len(key)) - first[group]) % 2 == 0))
        used, name = np.unique(key[at], return_inverse=True)
        ids = np.empty(len(used), np.int64)
        for i, k in enumerate(used.tolist()):
            ids[i] = rules.setdefault(k, fresh + len(rules))
        replace(at, ids[name])
    fresh += len(rules)
    while True:
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
        offset = np.arange(len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
        at = np.flatnonzero((part[1:] == part[:-1]) & (offset[:-1] % 2 == 0))
        if not len(at):
            break
        replace(at, fresh + np.arange(len(at)))
        fresh += len(at)
    columns = [np.concatenate([n[i] for n in nodes]) if nodes else np.zeros(0, np.int64) for i in range(4)]
    return dict(zip(("rule", "start", "left", "size"), columns, strict=True))


class Extensions:
    """Longest common extensions within one word sequence by rolling hashes (never too short; checked later)."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        value = (mix64(words.astype(np.uint64) + np.uint64(rng.integers(1, 2**62))) % np.uint64(PRIME)).astype(np.int64)
        self.power = np.ones(len(words) + 1, np.int64)
        base, known = int(rng.integers(2**16, PRIME)), 1
        while known <= len(words):
            more = min(known, len(words) + 1 - known)
            self.power[known : known + more] = self.power[:more] * pow(base, known, PRIME) % PRIME
            known += more
        self.sums = np.zeros(len(words) + 1, np.int64)
        np.cumsum(value * self.power[:-1] % PRIME, out=self.sums[1:])

    def equal(self, i, shift, length):
        """words[i : i + length] equals the same stretch ``shift`` words on."""
        a = (self.sums[i + length] - self.sums[i]) % PRIME * self.power[shift]
        return (a - (self.sums[i + shift + length] - self.sums[i + shift])) % PRIME == 0

    def longest(self, i, shift, most, back: bool):
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            fits = self.equal(i - mid if back else i, shift, mid)
            low, high = np.where(fits, mid, low), np.where(fits, high, mid - 1)
        return low


def crossing(words: np.ndarray, start: np.ndarray, left: np.ndarray, size: np.ndarray, seed: int = 0):
    """(node, start, end, period) of the runs across the boundary of each node; each has its least period."""
    two = np.unique((words[:-1].astype(np.int64) << 32) | words[1:], return_inverse=True)[1].astype(np.int64)
    n, order = len(words), np.argsort(two, kind="stable")
    place = two[order] * n + order
    border = start + left
    of = two[border - 1] * n
    # the period is the distance to another place of the two words at the boundary, inside the node
    low = np.searchsorted(place, of + np.maximum(start, border - 1 - size // MIN_EXPONENT))
    high = np.searchsorted(place, of + np.minimum(start + size - 1, border + size // MIN_EXPONENT))
    width = high - low
    find, found = Extensions(words, seed), []
    total = np.cumsum(width)
    a = 0
    while a < len(width):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + CHUNK, side="right")))
        node = np.repeat(np.arange(a, b), width[a:b])
        nth = np.arange(len(node)) - np.repeat(np.cumsum(width[a:b]) - width[a:b], width[a:b])
        other = order[low[node] + nth]
        shift = other - (border[node] - 1)
        node, shift = node[shift != 0], shift[shift != 0]
        at, q = border[node] + np.minimum(shift, 0), np.abs(shift)
        fits = (at - start[node] >= 0) & (start[node] + size[node] - at - q >= 0)
        node, at, q = node[fits], at[fits], q[fits]
        before = find.longest(at, q, at - start[node], True)
        after = find.longest(at, q, start[node] + size[node] - at - q, False)
        long = before + after + q >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
        found.append(np.stack([node, at - before, at + q + after, q])[:, long])
        a = b
    runs = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    runs = runs[:, np.lexsort((runs[3], runs[2], runs[1], runs[0]))]
    if runs.shape[1]:
        runs = runs[:, np.concatenate([[True], (runs[:3, 1:] != runs[:3, :-1]).any(axis=0)])]
    if all(np.array_equal(words[s : e - q], words[s + q : e]) for _, s, e, q in runs.T.tolist()):
        return runs
    return crossing(words, start, left, size, seed + 1)


def runs_in(words: np.ndarray, part: np.ndarray) -> np.ndarray:
    """Rows start, end, period of all runs of word ids, in order of start, then period; none crosses two parts."""
    nodes = grammar(words, part)
    nodes = {k: v[nodes["size"] >= MIN_LENGTH] for k, v in nodes.items()}
    if not len(nodes["rule"]):
        return np.zeros((3, 0), np.int64)
    order = np.argsort(nodes["rule"], kind="stable")
    nodes = {k: v[order] for k, v in nodes.items()}
    first = np.flatnonzero(np.concatenate([[True], nodes["rule"][1:] != nodes["rule"][:-1]]))
    uses = np.diff(np.append(first, len(order)))
    node, s, e, q = crossing(words, *(nodes[k][first] for k in ("start", "left", "size")))
    # to every place of the nonterminal
    each = np.repeat(np.arange(len(node)), uses[node])
    nth = np.arange(len(each)) - np.repeat(np.cumsum(uses[node]) - uses[node], uses[node])
    moved = nodes["start"][first[node[each]] + nth] - nodes["start"][first[node[each]]]
    s, e, q = s[each] + moved, e[each] + moved, q[each]
    if not len(s):
        return np.zeros((3, 0), np.int64)
    order = np.lexsort((s, q))
    s, e, q = s[order], e[order], q[order]
    far = np.unique(q, return_inverse=True)[1] * (2 * len(words) + 2)
    reach = np.maximum.accumulate(e + far)
    new = np.concatenate([[True], s[1:] + q[1:] + far[1:] > reach[:-1]])
    out = np.stack([s[new], np.maximum.reduceat(e, np.flatnonzero(new)), q[new]])
    return out[:, np.lexsort((out[2], out[0]))]


def runs_of(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Runs of the documents' word ids (``doc``: document of each word)."""
    hit = in_repeats(ids, doc)
    edge = np.concatenate([[True], (hit[1:] != hit[:-1]) | (doc[1:] != doc[:-1])]) if len(hit) else hit
    stretch = np.cumsum(edge) - 1
    long = hit & (np.bincount(stretch, minlength=1)[stretch] >= MIN_LENGTH) if len(hit) else hit
    at = np.flatnonzero(long)
    if not len(at):
        return np.zeros((3, 0), np.int64)
    words = np.unique(ids[at], return_inverse=True)[1]
    s, e, q = runs_in(words, stretch[at])
    return np.stack([at[s], at[s] + e - s, q])


def scan(texts: pa.Array, source=None):
    """(runs by document as an Arrow array, collapsed texts) of whole texts.

    ``source(i, n)`` may give, for document i of n words, the word number each of its words is copied from.
    """
    buf, off = text_buffer(texts)
    words = Words(buf, off, NON_SPACE)
    ids, _ = words.encoded(buf)
    n_docs, first = len(off) - 1, words.first
    copied = {}
    if source is not None:
        ids = ids.copy()
        for i in range(n_docs):
            if (src := source(i, int(words.count[i]))) is not None:
                copied[i] = src
                ids[first[i] : first[i + 1]] = ids[first[i] + src]
    s, e, q = runs_of(ids, words.doc)
    drop = np.zeros(len(ids) + 1, np.int64)
    np.add.at(drop, s + q, 1)
    np.add.at(drop, e, -1)
    keep = np.cumsum(drop[:-1]) == 0
    doc = words.doc[s] if len(s) else np.zeros(0, np.int64)
    ends = np.searchsorted(doc, np.arange(n_docs + 1))
    runs = pa.ListArray.from_arrays(
        pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (s - first[doc], e - s, q)], ["start", "length", "period"])
    )
    out = []
    for i in range(n_docs):
        text = buf[off[i] : off[i + 1]].tobytes().split()  # bytes.split() parts at the same six characters
        if i in copied:
            text = [text[j] for j in copied[i].tolist()]
        if ends[i + 1] > ends[i]:
            text = itertools.compress(text, keep[first[i] : first[i + 1]].tolist())
        out.append(b" ".join(text).decode())
    return runs, pa.array(out, pa.string())


def find(docs: DataFrame, source=None) -> DataFrame:
    """doc_id, ``runs`` by start then period, and ``collapsed`` (runs cut to their first period, words joined by one space).

    ``source(doc_id, n)``: see ``scan``; called in the tasks.
    """

    def run(batches):
        for b in slices(batches, "text"):
            ids = b.column("doc_id").to_pylist()
            runs, text = scan(b.column("text"), source and (lambda i, n, ids=ids: source(ids[i], n)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), runs, text], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id bigint, runs array<{RUN}>, collapsed string"
    )


def collapse(docs: DataFrame) -> DataFrame:
    """``docs`` with texts that hold runs collapsed; other rows, and all other columns, as they are."""
    at = docs.columns.index("text")

    def run(batches):
        for b in slices(batches, "text"):
            runs, text = scan(b.column(at))
            has = np.diff(runs.offsets.to_numpy()) > 0
            kept = pc.if_else(pa.array(has), text, b.column(at).cast(pa.string()))
            yield b.set_column(at, b.schema.field(at), kept.cast(b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
