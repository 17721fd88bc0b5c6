"""Operators 9 and 10 against brute force, over many partitions and on edge cases."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark import SparkContext
from llm_cases import SCHEMA, alnum_words, edge_docs, edge_rows, low, no_docs, row

from fulfilq.llm import decontaminate, fm_index, line_bitmap


def brute_hits(text, items, window=10):
    words = alnum_words(text)
    hit, found = set(), set()
    for item_id, item in items:
        w = alnum_words(item)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    found.add("" if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("n,top", [(1, 1), (50, 3), (400, 5), (700, 40)])
def test_fm_index_by_hand(n, top):
    rng = np.random.default_rng(n)
    s = rng.integers(0, top + 1, n)
    s[rng.random(n) < 0.1] = 0
    if n > 100:
        s[30:60] = s[60:90] = 1  # a long repeat
    index = fm_index.FMIndex(s, top)
    patterns = rng.integers(1, top + 1, (80, 3))
    lengths = rng.integers(1, 4, 80)
    patterns[np.arange(3)[None] >= lengths[:, None]] = 0
    low_, high = index.count(patterns, lengths)
    for p, k, a, b in zip(patterns, lengths, low_, high, strict=True):
        want = [i for i in range(n - k + 1) if (s[i : i + k] == p[:k]).all()]
        assert sorted(index.locate(np.arange(a, b))) == want


def items_rows():
    words = [f"q{i}" for i in range(40)]
    return [
        (1, " ".join(words[:25])),
        (2, "Short item of five words"),
        (3, None),
        (4, ""),
        (None, " ".join(words[10:22])),
        (5, "!?"),
        (6, " ".join(words[:12])),
    ]


def decon_rows():
    w = [f"q{i}" for i in range(40)]
    return [
        row(1, "before " + " ".join(w[3:13]).upper() + " after"),
        row(2, "x " + ", ".join(w[:30]) + "\nSHORT item-of five words short item of five words"),
        row(3, " ".join(w[:9])),
        row(4, None),
        row(5, ""),
        row(1, "before " + " ".join(w[3:13]).upper() + " after"),
        row(6, " ".join(w[:5]) + " " + " ".join(w[:10]) + " " + " ".join(w[5:12])),
        row(None, " ".join(w[11:21])),
    ]


@pytest.mark.parametrize("shard,block", [(1 << 20, 1 << 20), (7, 40)])
def test_decontamination_by_hand(spark, shard, block):
    items = spark.createDataFrame(items_rows(), "item_id bigint, text string")
    docs = spark.createDataFrame(decon_rows(), SCHEMA).repartition(3)
    got = decontaminate.hits(docs, items, shard_words=shard, block_bytes=block).collect()
    assert len(got) == len(decon_rows())
    for r in got:
        n_hit = sum(s["end"] - s["start"] for s in r["__spans"])
        assert (r["__n_words"], n_hit, list(r["__items"])) == brute_hits(r["text"], items_rows())


def test_cut_leaves_no_window(spark):
    items = spark.createDataFrame(items_rows(), "item_id bigint, text string")
    docs = spark.createDataFrame(decon_rows(), SCHEMA)
    out = decontaminate.cut(docs, items)
    assert out.schema == SCHEMA
    got = out.collect()
    for r in got:
        assert brute_hits(r["text"], items_rows())[1] == 0
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
    kept = {r["doc_id"]: r["text"] for r in got}
    assert kept[1] == "before \n after" and kept[3] == decon_rows()[2][1] and kept[4] is None
    # the first cut of document 6 brings words together that are a window again
    assert 6 not in kept or brute_hits(kept[6], items_rows())[1] == 0


def one_alive(monkeypatch):
    """Lets a test fail if a broadcast of phrases is made while another is alive; counts them."""
    made, alive, begin = [], set(), SparkContext.broadcast

    def broadcast(self, value):
        b = begin(self, value)
        if isinstance(value, decontaminate.Phrases):
            assert not alive
            alive.add(b)
            made.append(len(value.patterns))
            end = b.destroy
            b.destroy = lambda *a, **k: (alive.discard(b), end(*a, **k))
        return b

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    return made


def test_blocks_come_one_at_a_time(spark, monkeypatch):
    items = spark.createDataFrame(items_rows() * 2, "item_id bigint, text string")
    docs = spark.createDataFrame(decon_rows() * 3 + edge_rows(), SCHEMA).repartition(5)
    marks = [*docs.columns, *decontaminate.MARKS]
    one = sorted(map(str, decontaminate.hits(docs, items).select(marks).collect()))
    whole = sorted(map(str, decontaminate.cut(docs, items).collect()))
    made = one_alive(monkeypatch)
    many = sorted(map(str, decontaminate.hits(docs, items, block_bytes=80).select(marks).collect()))
    assert len(made) >= 3 and many == one
    assert sorted(map(str, decontaminate.cut(docs, items, block_bytes=80).collect())) == whole


def test_cut_of_many_blocks_searches_again(spark):
    w = [f"q{i}" for i in range(40)]
    nested = " ".join(w[:5] + w[20:30] + w[5:10])  # the inner window's cut makes the outer one
    items = spark.createDataFrame([(1, " ".join(w[:10])), (2, " ".join(w[20:30]))], "item_id bigint, text string")
    docs = spark.createDataFrame([row(1, nested), row(2, "clean " + nested + " end"), row(3, None)], SCHEMA)
    for block in (decontaminate.BLOCK_BYTES, 20):
        got = {r["doc_id"]: r["text"] for r in decontaminate.cut(docs, items, block_bytes=block).collect()}
        assert got == {2: "clean \n end", 3: None}


def test_decontamination_edges(spark):
    items = spark.createDataFrame(items_rows(), "item_id bigint, text string")
    assert decontaminate.hits(edge_docs(spark), items).count() == len(edge_rows())
    none = items.where("item_id < 0")
    clean = decontaminate.hits(edge_docs(spark), none).collect()
    assert len(clean) == len(edge_rows()) and not any(r["__spans"] for r in clean)
    assert decontaminate.hits(no_docs(spark), items).count() == 0
    assert decontaminate.cut(no_docs(spark), items).count() == 0


def brute_lines(rows):
    """{(doc, text): kept text} where keys of ten code points go after the least document."""
    last = 2**63 - 1
    lead = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            k = low(line.strip(" \t\n\x0b\f\r"))
            d = last if r[0] is None else r[0]
            if len(k) >= 10:
                lead[k] = min(lead.get(k, d), d)
    out = {}
    for r in rows:
        d = last if r[0] is None else r[0]
        lines = (r[1] or "").split("\n")
        keep = [x for x in lines if lead.get(low(x.strip(" \t\n\x0b\f\r")), d) >= d]
        out[r[0], r[1]] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def hot_rows():
    return [row(i, f"Own line number {i}\nthe line that everyone has\n\nshort\nthe line of group {i % 7}") for i in range(200, 0, -1)]


@pytest.mark.parametrize("rows", [edge_rows(), hot_rows(), hot_rows()[:2]])
def test_lines_by_hand(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute_lines(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the hot run crosses borders
    try:
        bitmaps = line_bitmap.keep_bitmaps(docs)
        out = line_bitmap.without_repeats(docs).collect()
        maps = {(r["doc"], r["row"]): r for r in bitmaps.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == len(rows)
    left = {}
    for r in rows:
        left.setdefault(r[0], []).append(want[r[0], r[1]][2])
    for r in out:
        assert (r["text"] or "") in left[r["doc_id"]]
    assert sum(m["n_dropped"] for m in maps.values()) == sum(v[1] for v in want.values())
    assert all(line_bitmap.unpack(m["keep"], m["n_lines"]).sum() == m["n_lines"] - m["n_dropped"] for m in maps.values())


def test_bitmap_round_trip_and_empty(spark):
    for n in (1, 7, 8, 9, 1000):
        gone = np.flatnonzero(np.random.default_rng(n).random(n) < 0.3)
        mask = line_bitmap.unpack(line_bitmap.pack(n, gone), n)
        assert (np.flatnonzero(~mask) == gone).all()
    assert line_bitmap.without_repeats(no_docs(spark)).count() == 0
    assert hashlib.sha256(line_bitmap.kept_text("", line_bitmap.pack(1, []), 1).encode()).hexdigest().startswith("e3b0")


def test_runs_cut_anywhere_lose_the_same_lines():
    """Partitions and batches that begin and end inside and between runs, settled by their border rows."""
    rng = np.random.default_rng(11)
    rows = sorted((bytes([h]) * 16, int(d), int(d), int(p)) for h in range(12) for d in rng.integers(0, 9, rng.integers(1, 7)) for p in range(2))
    least = {}
    for h, d, _, _ in rows:
        least[h] = min(least.get(h, d), d)
    want = sorted((d, r, p) for h, d, r, p in rows if d > least[h])

    def batch(part):
        h, d, r, p = zip(*part, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.binary()), pa.array(d, pa.int64()), pa.array(r, pa.int64()), pa.array(p, pa.int32())], ["h", "doc", "row", "pos"]
        )

    for _ in range(300):
        cuts = [0, *sorted(rng.integers(0, len(rows) + 1, rng.integers(0, 9))), len(rows)]
        found = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            step = int(rng.integers(1, 8))
            for out in line_bitmap.stream_runs(batch(rows[i : min(i + step, b)]) for i in range(a, b, step)):
                found += out.to_pylist()
        lead = {}
        for x in found:
            if x["kind"] == line_bitmap.BORDER:
                lead[x["h"]] = min(lead.get(x["h"], x["doc"]), x["doc"])
        gone = [x for x in found if x["kind"] == line_bitmap.DROP]
        gone += [x for x in found if x["kind"] == line_bitmap.PENDING and x["doc"] > lead[x["h"]]]
        assert sorted((x["doc"], x["row"], x["pos"]) for x in gone) == want
