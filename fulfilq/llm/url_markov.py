"""URL filter by a character language-model ratio (operator 6).

Two smoothed variable-order Markov models, one of accepted and one of rejected
URLs, give the log-likelihood of a URL; the difference per character decides.
Characters are folded to ``A`` symbols (A-Z to a-z, digits to 0, other
characters to one), so contexts of up to ``ORDER`` characters have at most
A ** (ORDER + 1) counts per model: a bound that does not grow with the corpus,
which is what makes the tables fit a broadcast. Counts of the longest order come
from all labelled URLs (Spark partial histograms, summed by gram); shorter
orders are their margins; each order is interpolated with the next shorter one
by Witten-Bell smoothing.

The threshold is calibrated on the labelled URLs of a fifth of the hosts, which
training leaves out whole (URLs of one host look alike, so a hold-out by URL
would measure what the model has seen): the largest score histogram bin at which
no more than ``FALSE_BLOCK`` of the held-out accepted URLs would be blocked, and
never above 0. Without held-out accepted URLs it is 0.

A null URL, or one without "://", has empty host and path; it is scored over
the text it has, and an empty one is allowed. Without labelled URLs of both
kinds the method allows everything. Repeated rows: one result each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import ascii_lower, text_buffer

ORDER = 3
SYMBOLS = "abcdefghijklmnopqrstuvwxyz0/.-_?=&#:%+~@"
A = len(SYMBOLS) + 2  # end of URL and any other character
END, OTHER = A - 2, A - 1
FALSE_BLOCK = 0.02
BINS, SPAN = 4096, 8.0
FOLDS = 5

_FOLD = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(SYMBOLS):
    _FOLD[ord(_c)] = _i
_FOLD[ord("A") : ord("Z") + 1] = _FOLD[ord("a") : ord("z") + 1]
_FOLD[ord("0") : ord("9") + 1] = _FOLD[ord("0")]


def grams(urls) -> tuple[np.ndarray, np.ndarray]:
    """(URL number, code of each character with its ORDER predecessors); END stands before and after."""
    buf, off = text_buffer(urls)
    lead = (buf & 0xC0) != 0x80  # one symbol per code point
    at = np.concatenate([[0], np.cumsum(lead)])[off]
    sym = _FOLD[buf[lead]]
    n = np.diff(at)
    url = np.repeat(np.arange(len(n)), n + 1)
    padded = np.full(int((n + 1).sum()) + ORDER, END, np.int64)
    start = np.cumsum(n + 1) - (n + 1)
    padded[np.repeat(start, n) + np.arange(len(sym)) - np.repeat(at[:-1], n) + ORDER] = sym
    place = np.arange(len(url)) - start[url]
    code = np.zeros(len(url), np.int64)
    for back in range(ORDER, -1, -1):
        s = padded[np.arange(len(url)) + ORDER - back]
        code = code * A + np.where(place >= back, s, END)
    return url, code


def count_batches(batches):
    """Partial histogram of a task: (accepted, gram, n)."""
    size = A ** (ORDER + 1)
    total: dict[int, np.ndarray] = {}
    for b in batches:
        ok = b.column("accepted").to_numpy(zero_copy_only=False).astype(bool)
        url, code = grams(b.column("url"))
        key, n = np.unique(code + ok[url] * size, return_counts=True)
        total.setdefault(0, np.zeros(2 * size, np.int64))[key] += n
    for t in total.values():
        key = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key >= size), pa.array(key % size), pa.array(t[key])], ["accepted", "gram", "n"]
        )


def log_table(grams_: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log p(symbol | ORDER symbols) by gram, interpolated over all orders (Witten-Bell)."""
    full = np.zeros(A ** (ORDER + 1))
    full[grams_] = counts
    p = np.full(A, 1.0 / A)
    for order in range(ORDER + 1):
        c = full.reshape(-1, A ** (order + 1)).sum(axis=0).reshape(-1, A)
        total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        lower = np.tile(p.reshape(-1, A), (len(c) // (p.size // A), 1)) if order else p.reshape(1, A)
        p = np.where(total > 0, (c + kinds * lower) / np.maximum(total + kinds, 1), lower)
    return np.log(p).reshape(-1).astype(np.float32)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return ascii_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


#: (verdict, host, path): a rule fits its host and subdomains where the path starts with the rule's.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; ties go to the rule listed first."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def train(labelled: DataFrame):
    """Broadcast of (accepted table, rejected table) from (url, accepted); None without both kinds.

    Collected rows are at most 2 * A ** (ORDER + 1), whatever the corpus holds.
    """
    counted = labelled.mapInArrow(count_batches, "accepted boolean, gram bigint, n bigint")
    t = counted.groupBy("accepted", "gram").agg(F.sum("n").alias("n")).toArrow()
    ok, gram, n = (t.column(c).to_numpy() for c in ("accepted", "gram", "n"))
    ok = ok.astype(bool)
    if not ok.any() or ok.all():
        return None
    tables = [log_table(gram[m].astype(np.int64), n[m]) for m in (ok, ~ok)]
    return labelled.sparkSession.sparkContext.broadcast(tables)


def score(pages: DataFrame, model) -> DataFrame:
    """Adds ``llr``: log-likelihood difference per character, accepted against rejected."""
    names = pages.columns

    def run(batches):
        good, bad = model.value
        gap = good.astype(np.float64) - bad
        for b in batches:
            url, code = grams(b.column("url"))
            n = np.bincount(url, minlength=b.num_rows)
            llr = np.bincount(url, weights=gap[code], minlength=b.num_rows) / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(llr)], [*names, "llr"])

    from pyspark.sql import types as T

    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField("llr", T.DoubleType())]))


def calibrate(held_out: DataFrame, false_block: float = FALSE_BLOCK) -> float:
    """Largest bin edge below which at most ``false_block`` of the held-out accepted URLs score; exact bin counts."""
    bin_ = F.floor((F.greatest(F.lit(-SPAN), F.least(F.col("llr"), F.lit(SPAN - 1e-9))) + SPAN) / (2 * SPAN) * BINS)
    rows = held_out.where("accepted").groupBy(bin_.alias("b")).agg(F.count("*").alias("n")).collect()
    n = np.zeros(BINS, np.int64)
    for r in rows:
        n[int(r["b"])] = r["n"]
    if not n.sum():
        return 0.0
    below = np.concatenate([[0], np.cumsum(n)[:-1]])
    edge = int(np.flatnonzero(below <= false_block * n.sum())[-1])
    return min(0.0, edge / BINS * 2 * SPAN - SPAN)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the score of every row of ``pages`` (page_id, url)."""
    host, path = parts(F.col("url"))
    p = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "by_rule": verdict})
    labelled = p.where("by_rule is not null").select(
        "url", (F.col("by_rule") == "allow").alias("accepted"), F.pmod(F.xxhash64("host"), F.lit(FOLDS)).alias("fold")
    )
    model = train(labelled.where("fold > 0").select("url", "accepted"))
    if model is None:
        return p.select("page_id", "host", "path", "rule", F.coalesce("by_rule", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("llr"))
    threshold = calibrate(score(labelled.where("fold = 0").select("url", "accepted"), model))
    own = F.when((F.col("url") != "") & (F.col("llr") < threshold), "block").otherwise("allow")
    return score(p, model).select("page_id", "host", "path", "rule", F.coalesce("by_rule", own).alias("verdict"), "llr")
