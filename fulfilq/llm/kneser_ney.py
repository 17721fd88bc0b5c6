"""Quality classifier: interpolated modified Kneser-Ney n-gram model (operator 2).

The units are UTF-8 bytes (case as it is, digits as 0), so a gram of
``ORDER`` bytes is one integer and every language is covered. One model per
language is trained on all its trusted documents but a fifth, chosen by hash,
which calibrates the threshold. A Spark pass counts grams per
task and sums them by gram; lower orders are continuation counts of the order
above; discounts come from each order's counts of counts. Joins of grams with
counts, contexts and the next lower order give the probability of every gram
that any document holds. Those probabilities, cut by hash into shards of at
about ``SHARD_ROWS`` rows, are joined with the documents one broadcast shard
after another: the partial scores of a shard are written and its broadcast is
released before the next is fetched, so driver and executors hold one shard
whatever the number of grams. Their sum is the log-likelihood of every whole text.

A document is kept if its perplexity per byte is at most ``SLACK`` times the
``QUANTILE`` of the held-out trusted documents of its language.

Null or empty text: no units, null perplexity, not kept. Null language: a
language of its own (""). A language without trusted text to train on or
to calibrate with has no threshold: kept. Repeated rows: one result each; no rows: no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import discard, materialize, slices, text_buffer

ORDER = 5
#: Grams in the broadcast head of the model (16 bytes each).
HEAD_ROWS = 2_000_000
#: Steps of occurrence classes per factor 2: a step is a factor of 1.19.
STEPS = 4
#: Other grams of a text handed on in one row; a longer list goes in parts.
PART = 100_000
QUANTILE = 0.995
#: Room above the quantile: prose that is new to the model stays, other kinds of text lie far above.
SLACK = 1.25
FOLDS = 5
#: Trusted ids are broadcast up to this many (16 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 2_000_000
#: Distinct grams a task holds before it hands them on.
HELD = 2_000_000
#: Text handled at once: a dozen 64-bit arrays over its bytes are held meanwhile.
SLICE = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[48:58] = 48
_FOLD[0] = 32  # 0 stands before a text


def text_grams(texts) -> tuple[np.ndarray, np.ndarray]:
    """(document, gram ending there) of every byte; a text is preceded by ORDER - 1 zero bytes."""
    buf, off = text_buffer(texts)
    n = np.diff(off)
    doc = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(buf)) - off[:-1][doc]
    byte = _FOLD[buf].astype(np.int64)
    gram = byte.copy()
    for back in range(1, ORDER):
        prev = np.zeros(len(byte), np.int64)
        prev[back:] = byte[:-back]
        prev[place < back] = 0
        gram |= prev << (8 * back)
    return doc, gram


def count_batches(batches):
    """Distinct (lang, gram) of a task with their count in trusted texts (c) and in all (n)."""
    langs: dict[str, int] = {}
    keys, sums = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)

    def rows():
        names = pa.array(list(langs), pa.string())
        lang = names.take(pa.array(keys >> (8 * ORDER)))
        counts = [pa.array(np.ascontiguousarray(x)) for x in sums.T]
        return pa.RecordBatch.from_arrays([lang, pa.array(keys & ((1 << 8 * ORDER) - 1)), *counts], ["lang", "g", "c", "n"])

    for b in slices(batches, "text", SLICE):
        of = np.array([langs.setdefault(x, len(langs)) for x in b.column("lang").to_pylist()], np.int64)
        trusted = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        doc, gram = text_grams(b.column("text"))
        gram |= of[doc] << (8 * ORDER)
        new, n_new = np.unique(gram[trusted[doc]], return_counts=True)
        rest, n_rest = np.unique(gram[~trusted[doc]], return_counts=True)
        every = np.concatenate([keys, new, rest])
        weight = np.concatenate([sums, np.stack([n_new, n_new], 1), np.stack([np.zeros_like(n_rest), n_rest], 1)])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], weight[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
        keys, sums = every[first], np.add.reduceat(weight, first) if len(first) else weight
        if len(keys) > HELD:
            yield rows()
            keys, sums = np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    if len(keys):
        yield rows()


def flagged(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """doc_id, lang, text, trusted (the model learns from it), held (trusted, but kept for calibration)."""
    ids = trusted_ids.select(F.col("doc_id").cast("bigint").alias("__t")).where("__t is not null").distinct()
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    d = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), "text"
    )
    known, held = F.col("__t").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    return d.join(ids, F.col("doc_id") == F.col("__t"), "left").select(
        "doc_id", "lang", "text", (known & ~held).alias("trusted"), (known & held).alias("held")
    )


def low(col, n: int):
    """The last n bytes of a gram."""
    return col.bitwiseAND(F.lit((1 << 8 * n) - 1))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) by counts of counts."""
    n = [F.count(F.when(F.col("c") == k, 1)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    d = counts.groupBy("lang").agg(*n)
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def rate(k):
        raw = k - (k + 1) * y * F.try_divide(f"n{k + 1}", f"n{k}")
        # too few counts to estimate it: half of the count
        return F.when((raw > 0) & (raw < k), raw).otherwise(k / 2).alias(f"d{k}")

    return d.select("lang", rate(1), rate(2), rate(3))


def probabilities(grams: DataFrame) -> DataFrame:
    """Table of (lang, g, logp, n) of every gram of ``grams`` (lang, g, c, n) in a language with counts."""
    steps = []
    counts, asked = {ORDER: grams.where("c > 0")}, {ORDER: grams.select("lang", "g")}
    for n in range(ORDER - 1, 0, -1):
        g = low(F.col("g"), n).alias("g")
        counts[n] = materialize(counts[n + 1].groupBy("lang", g).agg(F.count("*").alias("c")), f"kn-counts{n}")
        asked[n] = materialize(asked[n + 1].select("lang", g).distinct(), f"kn-asked{n}")
        steps += [counts[n], asked[n]]
    p = None
    for n in range(1, ORDER + 1):
        head = F.shiftright("g", 8).alias("h")
        by_count = [F.count(F.when(F.col("c") == 1, 1)).alias("m1"), F.count(F.when(F.col("c") == 2, 1)).alias("m2")]
        ctx = counts[n].groupBy("lang", head).agg(
            F.sum("c").alias("total"), *by_count, F.count(F.when(F.col("c") > 2, 1)).alias("m3")
        )
        ctx = ctx.join(discounts(counts[n]), "lang")
        ctx = ctx.withColumn("spare", F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3"))
        r = asked[n].withColumn("h", head)
        r = r.join(counts[n], ["lang", "g"], "left").join(ctx, ["lang", "h"], "left")
        if p is None:
            r = r.where("total is not null").withColumn("lower", F.lit(1 / 256))
        else:
            r = r.withColumn("tail", low(F.col("g"), n - 1)).join(p.withColumnRenamed("g", "tail"), ["lang", "tail"])
            r = r.withColumnRenamed("p", "lower")
        c = F.coalesce("c", F.lit(0))
        cut = F.when(c == 0, 0.0).when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))
        own = (c - cut + F.col("spare") * F.col("lower")) / F.col("total")
        p = r.select("lang", "g", F.when(F.col("total").isNull(), F.col("lower")).otherwise(own).alias("p"))
        if n < ORDER:
            p = materialize(p, f"kn-p{n}")
            steps.append(p)
    p = p.join(grams.select("lang", "g", "n"), ["lang", "g"])
    out = materialize(p.select("lang", "g", F.log("p").alias("logp"), "n"), "kn-model")
    discard(*steps)
    return out


def by_language(t: pa.Table) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """{lang: (grams, log probabilities and a last 0 for any other gram)} of a shard of the table."""
    lang = t.column("lang").combine_chunks().dictionary_encode()
    if isinstance(lang, pa.ChunkedArray):
        lang = lang.combine_chunks()
    of, g, logp = lang.indices.to_numpy(), t.column("g").to_numpy(), t.column("logp").to_numpy()
    return {x: (g[of == i], np.append(logp[of == i], 0.0)) for i, x in enumerate(lang.dictionary.to_pylist())}


def step(n):
    """Class of a number of occurrences."""
    return F.floor(F.log2(F.col(n)) * STEPS)


def head_step(table: DataFrame, head_rows: int) -> int | None:
    """Least class from which on the grams are at most ``head_rows``; None: they all are."""
    sizes = {r["s"]: r["count"] for r in table.groupBy(step("n").alias("s")).count().collect()}  # at most 64 * STEPS rows
    if sum(sizes.values()) <= head_rows:
        return None
    held, least = 0, max(sizes) + 1
    for s in sorted(sizes, reverse=True):
        held += sizes[s]
        if held > head_rows:
            break
        least = s
    return least


def score_with(d: DataFrame, shared, tail: bool) -> DataFrame:
    """Scores of the rows of ``d`` (doc_id, lang, held, text) by the broadcast head of the model.

    A row number, doc_id, lang, held, ``logp`` and ``found`` (grams with a
    probability there); with ``tail`` the other grams of the text ``g`` and how
    often each occurs ``m``, in further rows of the same number where they are many.
    """
    schema = "row bigint, doc_id bigint, lang string, held boolean, logp double, found bigint, g array<bigint>, m array<bigint>"
    names = ["row", "doc_id", "lang", "held", "logp", "found", "g", "m"]

    def run(batches):
        models = {x: (pa.array(keys), value) for x, (keys, value) in shared.value.items()}
        row = TaskContext.get().partitionId() << 33
        for b in slices(batches, "text", SLICE):
            doc, gram = text_grams(b.column("text"))
            langs = b.column("lang").to_pylist()
            of = np.array(langs, object)
            logp, found = np.zeros(len(of)), np.zeros(len(of), np.int64)
            other = np.ones(len(doc), bool)
            for x in {*of} & {*models}:
                keys, value = models[x]
                mine = np.flatnonzero((of == x)[doc]) if len({*of}) > 1 else np.arange(len(doc))
                at = pa.compute.index_in(pa.array(gram[mine]), value_set=keys)
                at = at.fill_null(len(keys)).to_numpy(zero_copy_only=False)
                logp += np.bincount(doc[mine], weights=value[at], minlength=len(of))
                found += np.bincount(doc[mine], weights=at < len(keys), minlength=len(of)).astype(np.int64)
                other[mine] = at == len(keys)
            number = row + np.arange(len(of))
            row += len(of)
            own = [pa.array(number), *(b.column(c) for c in ("doc_id", "lang", "held")), pa.array(logp), pa.array(found)]
            if not tail:
                none = pa.nulls(len(of), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*own, none, none], names)
                continue
            rest = np.flatnonzero(other)
            border = np.searchsorted(doc[rest], np.arange(len(of) + 1))
            of_row, g, m = [], [], []
            for k in range(len(of)):
                every, times = np.unique(gram[rest[border[k] : border[k + 1]]], return_counts=True)
                for i in range(0, max(1, len(every)), PART):
                    of_row.append(k)
                    g.append(every[i : i + PART])
                    m.append(times[i : i + PART])
            out = pa.RecordBatch.from_arrays(own, names[:-2]).take(pa.array(of_row))
            # the score of a text counts once, in its first row
            again = pa.array(np.append(False, np.diff(of_row) == 0))
            for c, zero in (("logp", 0.0), ("found", 0)):
                out = out.set_column(names.index(c), c, pa.compute.if_else(again, zero, out.column(c)))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(g, kind), pa.array(m, kind)], names)

    return d.select("doc_id", "lang", "held", "text").mapInArrow(run, schema)


def add_scores(d: DataFrame, table: DataFrame, head_rows: int) -> DataFrame:
    """Table of the rows of ``d`` (doc_id, lang, text, held) without text, with ``logp`` and ``found`` (bytes with a probability)."""
    least = head_step(table, head_rows)
    head = table if least is None else table.where(step("n") >= least)
    shared = d.sparkSession.sparkContext.broadcast(by_language(head.select("lang", "g", "logp").toArrow()))
    # the row numbers hold because the rows are stored before they are used
    passed = materialize(score_with(d, shared, least is not None), "kn-passed")
    shared.destroy()
    if least is None:
        return passed.drop("row", "g", "m")
    rest = table.where(step("n") < least).select("lang", "g", F.col("logp").alias("p"))
    asked = passed.select("row", "lang", F.explode(F.arrays_zip("g", "m")).alias("x")).select("row", "lang", "x.g", "x.m")
    # summed by row within each task of the join before the rows meet again
    more = asked.join(rest, ["lang", "g"]).groupBy("row").agg(F.sum(F.col("p") * F.col("m")).alias("logp"), F.sum("m").alias("found"))
    own = passed.groupBy("row").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in ("doc_id", "lang", "held")], F.sum("logp").alias("a"), F.sum("found").alias("b")
    )
    out = own.join(more, "row", "left").select(
        "doc_id", "lang", "held",
        (F.col("a") + F.coalesce("logp", F.lit(0.0))).alias("logp"),
        (F.col("b") + F.coalesce("found", F.lit(0))).alias("found"),
    )
    out = materialize(out, "kn-scored")
    discard(passed)
    return out


def classify(
    docs: DataFrame, trusted_ids: DataFrame, quantile: float = QUANTILE, slack: float = SLACK, head_rows: int = HEAD_ROWS
) -> DataFrame:
    """doc_id, lang, n_bytes, log_likelihood, perplexity, threshold, kept of every row of ``docs`` (doc_id, lang, text)."""
    d = flagged(docs, trusted_ids)
    parts = d.mapInArrow(count_batches, "lang string, g bigint, c bigint, n bigint")
    grams = materialize(parts.groupBy("lang", "g").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "kn-grams")
    table = probabilities(grams)
    scored = add_scores(d, table, head_rows)
    discard(grams, table)
    scored = scored.withColumn("perplexity", F.when(F.col("found") > 0, F.exp(-F.col("logp") / F.col("found"))))
    at = F.percentile_approx("perplexity", quantile, 10_000)
    limit = scored.where("held").groupBy("lang").agg((at * slack).alias("threshold"))
    out = scored.join(limit.withColumnRenamed("lang", "l"), F.col("lang") == F.col("l"), "left")
    kept = F.when(F.col("threshold").isNull(), F.lit(True)).otherwise(
        F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    )
    return out.select(
        "doc_id", "lang", F.col("found").alias("n_bytes"), F.col("logp").alias("log_likelihood"), "perplexity", "threshold",
        kept.alias("kept"),
    )
