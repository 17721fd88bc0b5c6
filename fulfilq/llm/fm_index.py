"""FM-index over word symbols: suffix array, wavelet-tree ranks, sampled positions.

``symbols``: 1..top are searchable words, 0 is any other word or a document
end. Every 0 is a symbol of its own, larger than all words and ordered by
position, so no match crosses it and long runs of repeated text cost no more
than their length. Runs of 0 are one symbol in the index.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(sym: np.ndarray, n_words: int) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(sym)
    ends = np.flatnonzero(sym == 0)
    key = sym.astype(np.int64)
    key[ends] = n_words + 1 + np.arange(len(ends))
    sa = np.argsort(key, kind="stable")
    s = key[sa]
    head = np.ones(n, bool)
    head[1:] = s[1:] != s[:-1]
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[sa] = group
    rank[n] = -1
    alone = head & np.append(head[1:], True)
    live = sa[~alone]
    k = 1
    while len(live):
        old = rank[live]
        nxt = rank[np.minimum(live + k, n)]
        order = np.lexsort((nxt, old))
        live, old, nxt = live[order], old[order], nxt[order]
        m = len(live)
        block = np.ones(m, bool)
        block[1:] = old[1:] != old[:-1]
        start = np.maximum.accumulate(np.where(block, np.arange(m), 0))
        slot = old + np.arange(m) - start
        sa[slot] = live
        sub = block.copy()
        sub[1:] |= nxt[1:] != nxt[:-1]
        rank[live] = slot[np.maximum.accumulate(np.where(sub, np.arange(m), 0))]
        live = live[~(sub & np.append(sub[1:], True))]
        k *= 2
    return sa


class Bits:
    """Bit vector with ranks: 64-bit words and a running count."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.zeros((n // 64 + 1) * 8, np.uint8)
        b = np.packbits(bits, bitorder="little")
        packed[: len(b)] = b
        self.words = packed.view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])[:-1]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w, r = i >> 6, (i & 63).astype(np.uint64)
        part = self.words[w] & ((np.uint64(1) << r) - np.uint64(1))
        return self.before[w] + np.bitwise_count(part)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class Wavelet:
    """Wavelet tree, one bit vector per level over the whole sequence."""

    def __init__(self, seq: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (seq >> level) & 1 == 1
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(seq) - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.start = self.walk(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def walk(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for j, bits in enumerate(self.bits):
            one = (c >> (self.levels - 1 - j)) & 1 == 1
            r = bits.rank(i)
            i = np.where(one, self.zeros[j] + r, i - r)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol c stands before position i."""
        return self.walk(c, i) - self.start[c]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at i, its rank before i)."""
        c = np.zeros(len(i), np.int64)
        for j, bits in enumerate(self.bits):
            one, r = bits.get(i), bits.rank(i)
            c = c * 2 + one
            i = np.where(one, self.zeros[j] + r, i - r)
        return c, i - self.start[c]


class FMIndex:
    def __init__(self, symbols: np.ndarray, top: int):
        """symbols: one per word of the shard, 0 where a match must end."""
        z = symbols == 0
        keep = ~z
        keep[1:] |= z[1:] & ~z[:-1]  # the first of each run of zeros
        at = np.flatnonzero(keep)
        seq = symbols[at]
        if not len(seq) or seq[-1] != 0:
            seq, at = np.append(seq, 0), np.append(at, len(symbols))
        self.place, n = at, len(seq)
        sa = suffix_array(seq, top)
        bwt = seq[sa - 1]  # the last symbol is 0, so row 0's predecessor is one too
        self.tree = Wavelet(bwt, top)
        counts = np.bincount(seq, minlength=top + 1)
        self.first = np.concatenate([[0, 0], np.cumsum(counts[1:])])  # rows before the words' rows; zeros come last
        marked = (sa % SAMPLE == 0) | (bwt == 0)
        self.marked = Bits(marked)
        self.sampled = sa[marked]
        self.n = n

    def count(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of patterns (rows of symbols, filled up with 0), searched from their last symbol."""
        m = len(patterns)
        low, high = np.zeros(m, np.int64), np.full(m, self.n, np.int64)
        live = np.arange(m)
        for j in range(patterns.shape[1]):
            live = live[(lengths[live] > j)]
            c = patterns[live, lengths[live] - 1 - j]
            a = self.first[c] + self.tree.rank(c, low[live])
            b = self.first[c] + self.tree.rank(c, high[live])
            low[live], high[live] = a, np.maximum(a, b)
            live = live[a < b]
            if not len(live):
                break
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the shard's words of each row, by walking back to a sampled one."""
        out = np.empty(len(rows), np.int64)
        open_, row, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            hit = self.marked.get(row)
            out[open_[hit]] = self.sampled[self.marked.rank(row[hit])] + steps
            open_, row = open_[~hit], row[~hit]
            c, r = self.tree.access(row)
            row = self.first[c] + r
            steps += 1
        return self.place[out]
