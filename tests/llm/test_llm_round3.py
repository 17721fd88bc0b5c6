"""Operators 11, 12 and 13 against brute force and on edge cases."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import edge_docs, edge_rows, no_docs, row, space_words
from pyspark.sql import functions as F

from fulfilq.llm import hash_ring, periodic_runs, whitening
from fulfilq.llm.queries import QUERIES, planted_source

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------
# 11 periodic runs
# ---------------------------------------------------------------------------
def runs_by_hand(w):
    """(start, end, least period) of every maximal stretch of at least 24 words and three periods."""
    out = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def random_words(rng):
    w = []
    while len(w) < rng.randint(0, 260):
        k, a = rng.random(), rng.randint(1, 5)
        if k < 0.4:
            w += ([rng.randint(0, a) for _ in range(rng.randint(1, 12))] * rng.randint(1, 9))[: rng.randint(1, 90)]
        elif k < 0.6:
            w += [rng.randint(0, 50) for _ in range(rng.randint(1, 20))]
        else:
            s = rng.randint(0, max(0, len(w) - 1))
            w += w[s : s + rng.randint(1, 60)]
    return w


def test_runs_of_random_words_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        docs = [random_words(rng) for _ in range(rng.randint(1, 4))]
        ids = np.array([x for d in docs for x in d], np.int64)
        doc = np.array([i for i, d in enumerate(docs) for _ in d], np.int64)
        want, low = [], 0
        for d in docs:
            want += [(s + low, e + low, q) for s, e, q in runs_by_hand(d)]
            low += len(d)
        assert [tuple(x) for x in periodic_runs.runs_of(ids, doc).T.tolist()] == want


def test_grammar_derives_the_words():
    rng = random.Random(6)
    for _ in range(30):
        w = np.array(random_words(rng) or [1], np.int64)
        nodes = periodic_runs.grammar(w, np.zeros(len(w), np.int64))
        by_rule = {}
        for r, s, left, n in zip(*(nodes[k].tolist() for k in ("rule", "start", "left", "size")), strict=True):
            assert by_rule.setdefault(r, (left, tuple(w[s : s + n]))) == (left, tuple(w[s : s + n]))
        assert len(w) < 2 or (0, len(w)) in set(zip(nodes["start"].tolist(), nodes["size"].tolist(), strict=True))
        assert len(nodes["rule"]) == len(w) - 1  # a binary tree over all words


def test_extents_that_a_collision_made_too_long_are_looked_for_again(monkeypatch):
    w = np.array([0, 1, 2] * 20 + [3, 4] + [0, 1, 2] * 20, np.int64)
    right = periodic_runs.runs_in(w, np.zeros(len(w), np.int64))
    real, calls = periodic_runs.Extensions.equal, []

    def lying(self, i, shift, length):
        calls.append(1)
        return np.ones(len(length), bool) if len(calls) < 9 else real(self, i, shift, length)

    monkeypatch.setattr(periodic_runs.Extensions, "equal", lying)
    assert np.array_equal(periodic_runs.runs_in(w, np.zeros(len(w), np.int64)), right)


@pytest.mark.parametrize("w", [[0] * 50_000, [0, 1] * 20_000, list(range(1000)) * 40])
def test_long_periodic_words_are_one_run(w):
    got = periodic_runs.runs_of(np.array(w), np.zeros(len(w), np.int64)).T.tolist()
    assert got == [[0, len(w), len(set(w))]]


def op11_by_hand(doc_id, text):
    w = space_words(text)
    if doc_id is not None and w and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = runs_by_hand(w)
    best = max(runs, key=lambda r: (Fraction(r[1] - r[0], r[2]), -r[0], -r[2]), default=None)
    drop = {i for s, e, q in runs for i in range(s + q, e)}
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    four = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_op11_query_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = [r for r in docs if len(space_words(r["text"])) < 1500]  # brute force is quadratic
    assert len(short) > 180
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in short:
        assert got[r["doc_id"]] == op11_by_hand(r["doc_id"], r["text"])
    assert sum(x[1] > 0 for x in got.values()) > 10


def test_runs_edge_cases(spark):
    more = [row(20, "a\tb\x0bc " * 30), row(20, "a\tb\x0bc " * 30), row(21, "x " * 23), row(22, "x " * 24), row(23, "é " * 200_000)]
    docs = edge_docs(spark).unionByName(spark.createDataFrame(more, edge_docs(spark).schema))
    got = periodic_runs.find(docs).collect()
    assert len(got) == len(edge_rows()) + 5
    by = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got}
    assert by[4] == by[5] == by[21] == [] and by[20] == [(0, 90, 3)] and by[22] == [(0, 24, 1)] and by[23] == [(0, 200_000, 1)]
    text = {r["doc_id"]: r["collapsed"] for r in got}
    assert text[20] == "a b c" and text[22] == "x" and text[4] == "" and text[10] == "Öl ß é"
    kept = periodic_runs.collapse(docs)
    assert kept.schema == docs.schema
    rows = {r["doc_id"]: r for r in kept.collect()}
    assert rows[20]["text"] == "a b c" and rows[4]["text"] is None and rows[1]["text"] == edge_rows()[0][1]
    assert rows[20]["n_words"] == "extra"
    assert periodic_runs.find(no_docs(spark)).count() == 0 == periodic_runs.collapse(no_docs(spark)).count()


def test_planted_source_copies_from_earlier_words():
    hit = [i for i in range(300) if planted_source(i, 100) is not None]
    assert 10 < len(hit) < 60 and planted_source(None, 100) is None and planted_source(hit[0], 0) is None
    assert all((planted_source(i, 100) <= np.arange(100)).all() for i in hit)


# ---------------------------------------------------------------------------
# 12 whitening
# ---------------------------------------------------------------------------
def charpoly_by_hand(a):
    """Faddeev and LeVerrier's recurrence in fractions; constant first."""
    d = len(a)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = sum(a[i][x] * m[x][i] for i in range(d) for x in range(d))
        c[d - k] = -am / k
    return [int(x) for x in c]


@pytest.mark.parametrize("d", [1, 2, 3, 6])
def test_characteristic_polynomial_is_exact(spark, d):
    rng = np.random.default_rng(d)
    x = rng.integers(-(10**9), 10**9, (d, d)).astype(object)
    a = x.T.dot(x)
    assert whitening.characteristic_polynomial(spark, a) == charpoly_by_hand(a.tolist())
    if d > 2:
        a[:, 0] = a[0, :] = 0  # a zero column: pivots vanish
        assert whitening.characteristic_polynomial(spark, a) == charpoly_by_hand(a.tolist())


def test_roots_with_multiplicity():
    poly = [1]
    for r in (7, 7, 3, 10**20, 10**20 + 1, 0, 5):  # (t - r) for each
        poly = [(poly[i - 1] if i else 0) - (r * poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
    got = [(Fraction(n) / Fraction(2) ** b, m) for n, b, m in whitening.largest_roots(poly, 32)]
    want = [(10**20 + 1, 1), (10**20, 1), (7, 2), (5, 1), (3, 1)]
    assert [m for _, m in got] == [m for _, m in want]
    assert all(abs(x / y - 1) < Fraction(1, 2**100) for (x, _), (y, _) in zip(got, want, strict=True))


def test_scatter_is_exact_for_large_entries():
    x = np.random.default_rng(1).integers(-(2**51), 2**51, (50, 3))
    y = x.astype(object)
    assert (whitening.exact_scatter(x) == y.T.dot(y)).all()


def test_whitening_against_a_plain_eigensolver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, SF).toPandas()
    v = np.array([r["embedding"] for r in rows.orderBy("vec_id").collect()])
    x = np.floor(64 * v) + 1_000_000
    w, u = np.linalg.eigh(np.cov(x.T, bias=True))
    w, u = w[::-1][:32], u[:, ::-1][:, :32]
    assert len(got) == 32 * len(v) and got["n"].unique().tolist() == [len(v)]
    mine = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    plain = (x - x.mean(0)) @ u / np.sqrt(w)
    sign = np.sign((mine * plain).sum(0))
    assert np.abs(mine - plain * sign).max() < 1e-8
    assert np.allclose(got["explained"][:32], w / np.cov(x.T, bias=True).trace(), rtol=1e-12)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    exact = [sum(int(len(v) * a - b) ** 2 for a, b in zip(r, x.sum(0), strict=True)) for r in x]
    assert got.groupby("vec_id")["deviation"].first().tolist() == exact


def vectors(spark, *rows):
    return spark.createDataFrame([(i, list(r) if r is not None else None, "z") for i, r in enumerate(rows)],
                                 "vec_id bigint, embedding array<float>, n string")


def test_whitening_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1.0, 2.0, 0.5), (0.25, -1.0, 0.5), (0.25, -1.0, 0.5), (3.0, 0.0, 0.5)]
    bad = [None, (), (nan, 1.0, 1.0), (1.0, inf, 1.0), (1.0, None, 1.0), (1.0, 2.0)]
    got = whitening.whiten(vectors(spark, *good, *bad)).toPandas()
    # the third entry is constant and the rest has rank two: two components; repeated rows count each
    assert sorted(got["vec_id"].unique()) == [0, 1, 2, 3] and sorted(got["component"].unique()) == [1, 2]
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(w.T @ w / 4, np.eye(2)) and np.allclose(w.mean(0), 0)
    assert whitening.whiten(vectors(spark)).count() == 0
    assert whitening.whiten(vectors(spark, (1.0, 2.0), (1.0, 2.0))).count() == 0
    assert whitening.whiten(vectors(spark, None, (nan,))).count() == 0
    same = whitening.whiten(vectors(spark, (1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0))).toPandas()  # one eigenvalue twice
    w = same.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.allclose(w.T @ w / 4, np.eye(2)) and np.allclose(same["explained"], 0.5)
    with pytest.raises(Exception, match="2\\^52"):
        whitening.whiten(vectors(spark, (1e30,), (2.0,))).count()


# ---------------------------------------------------------------------------
# 13 hash ring
# ---------------------------------------------------------------------------
def placed_by_hand(counts, n_shards, slack):
    """Row by row, hop by hop: shard of every rank of every cell."""
    places, owner = hash_ring.virtual_nodes(n_shards)
    left = hash_ring.room(int(counts.sum()), n_shards, slack).tolist()
    order = sorted(np.flatnonzero(counts).tolist(), key=lambda c: int(hash_ring.mix64(np.array([c + 1], np.uint64))[0]))
    out = {c: [] for c in order}
    waiting = [(c, int(counts[c]), int(np.searchsorted(places, c)) % len(places)) for c in order]
    while waiting:
        again = []
        for c, n, node in waiting:
            s = int(owner[node])
            t = min(n, left[s])
            left[s] -= t
            out[c] += [s] * t
            if n > t:
                again.append((c, n - t, (node + 1) % len(places)))
        waiting = again
    return out


@pytest.mark.parametrize(("n_shards", "slack"), [(1, 0.0), (7, 0.0), (40, 0.0), (40, 0.1)])
def test_ring_plan_equals_row_by_row(n_shards, slack):
    rng = np.random.default_rng(3)
    counts = np.zeros(hash_ring.CELLS, np.int64)
    np.add.at(counts, rng.integers(0, hash_ring.CELLS, 3000), 1)
    counts[77] += 2000  # a hot place
    got, want = hash_ring.plan(counts, n_shards, slack), placed_by_hand(counts, n_shards, slack)
    slots = [[] for _ in range(n_shards)]
    for c, lo, hi, s, base in zip(*(x.tolist() for x in got.values()), strict=True):
        assert want[c][lo:hi] == [s] * (hi - lo)
        slots[s] += range(base, base + hi - lo)
    assert all(sorted(x) == list(range(len(x))) for x in slots)
    sizes = np.array([len(x) for x in slots])
    assert sizes.sum() == counts.sum() and (sizes <= hash_ring.room(int(counts.sum()), n_shards, slack)).all()
    if not slack:
        assert sizes.max() - sizes.min() <= 1


def test_one_more_shard_moves_few_rows():
    counts = np.bincount(np.random.default_rng(4).integers(0, hash_ring.CELLS, 400_000), minlength=hash_ring.CELLS)

    def owners(n, slack):
        p = hash_ring.plan(counts, n, slack)
        out = np.zeros(int(counts.sum()), np.int64)
        first = np.cumsum(counts) - counts
        for c, lo, hi, s in zip(*(p[k].tolist() for k in ("__ring_cell", "__ring_low", "__ring_high", "shard")), strict=True):
            out[first[c] + lo : first[c] + hi] = s
        return out

    for slack, most in ((0.0, 0.15), (0.25, 0.04)):  # the least possible is 1 / 41 = 0.024
        assert (owners(40, slack) != owners(41, slack)).mean() < most


def test_op13_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_hash_ring"](spark, SF).collect()
    assert len(got) == len(docs)
    slots = {}
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(40)) and all(sorted(x) == list(range(5)) for x in slots.values())
    assert {tuple(r) for r in QUERIES["op13_hash_ring"](spark, SF).collect()} == {tuple(r) for r in got}  # reruns agree


def test_ring_edge_cases(spark):
    hot = [row(i % 50 + 100 if i % 3 else 7, f"text {i % 40}" if i % 5 else "copy") for i in range(3000)]  # a third on one key
    docs = edge_docs(spark).unionByName(spark.createDataFrame(hot, edge_docs(spark).schema)).withColumn("slot", F.lit("theirs"))
    for n in (1, 9):
        got = hash_ring.assign(docs.repartition(5), ["doc_id"], n, content=["doc_id", "text"]).collect()
        assert len(got) == len(edge_rows()) + 3000
        slots = {}
        for r in got:
            slots.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        sizes = [len(x) for x in slots.values()]
        assert len(sizes) == n and max(sizes) - min(sizes) <= 1
        assert {r["n_words"] for r in got} == {"extra"}
    assert hash_ring.assign(no_docs(spark), ["doc_id"], 5).count() == 0
    few = hash_ring.assign(edge_docs(spark), ["doc_id"], 40).collect()  # fewer rows than shards
    assert sorted(r["slot"] for r in few) == [0] * len(edge_rows())
