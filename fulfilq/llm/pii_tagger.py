"""Personal data by rules and a character BiLSTM-CRF (operator 7).

The rules' spans stand. A bidirectional LSTM with CRF transitions, trained in
numpy from labelled spans, adds spans that rules miss.

Training: one Spark pass cuts a window around every rule span, around numbers
that are none, and one window of each document without either. Of each of these
kinds the ``PER_KIND`` distinct windows of least hash, a bounded sample, are
collected, so no kind crowds out another. ``TRAIN_WINDOWS`` examples are made
from them: sampled windows with other digits, and made spans set into corpus
text, half of them in forms that the rules miss (``pii_planted``: spelt-out
addresses, other separators, numbers without "+"). The number of steps is fixed,
so a small corpus trains as long as a large one. Labels are of form: a number
that looks like a card is one, its check digit is looked at afterwards.

Tagging: every text is cut into overlapping windows over its whole length. A
span must hold a digit, an "@" or the word "dot", so a window without any is all
"outside" and is not run through the network. Where windows overlap, the scores
of a character are averaged, each window weighted by how far inside it the
character lies; then one Viterbi decoding runs over the whole stretch of windows,
with "outside" before and after it. An added span must be what it claims: 13 to
19 digits that pass Luhn's test, four numbers up to 255, 9 to 15 digits, an
address with an "at" and a "dot"; and it may not touch a rule's span.

Null or empty text: no spans. Repeated rows: one result each. No rows: rules
only. Extra columns are not read. Memory grows with a slice of text or with one
very long text (about 50 bytes a character of a stretch that holds digits).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fulfilq.llm import bilstm_crf, pii_planted
from fulfilq.llm.common import slices
from fulfilq.llm.pii_rules import _CARD, KINDS, base_spans, luhn

WINDOW, MARGIN = 128, 24
PER_KIND, TRAIN_WINDOWS, TRAIN_LENGTH, STEPS = 300, 5000, 80, 450
TAGS = 1 + 2 * len(KINDS)
BATCH = 512
OUTSIDE, NEVER = 0, -1e4


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def is_digit(c: np.ndarray) -> np.ndarray:
    return (c >= 48) & (c <= 57)


def tag_row(n: int, spans, low: int) -> np.ndarray:
    tags = np.zeros(n, np.int8)
    for kind, s, e in spans:
        s, e, k = max(s - low, 0), min(e - low, n), KINDS.index(kind)
        if s < e:
            tags[s:e] = 2 + 2 * k
            tags[s] = 1 + 2 * k
    return tags


def label_spans(text: str) -> list[tuple[str, int, int]]:
    """Rule spans and numbers in the form of a card, whatever their check digit; by start."""
    spans = base_spans(text)
    taken = {(s, e) for k, s, e in spans if k == "card"}
    for m in _CARD.finditer(text):
        n = len(m[0]) - m[0].count(" ") - m[0].count("-")
        if 13 <= n <= 19 and m.span() not in taken:
            spans.append(("card", *m.span()))
    return sorted(spans, key=lambda x: x[1])


def window_batches(batches):
    """Labelled windows: (kind, key, text, tags); one of kind "plain" of a text without numbers."""
    for b in slices(batches, "text"):
        kinds, keys, texts, rows = [], [], [], []

        def add(kind, text, low, spans):
            part = text[low : low + TRAIN_LENGTH]
            kinds.append(kind)
            texts.append(part)
            rows.append(tag_row(len(part), spans, low).tobytes())
            keys.append(xxhash.xxh64_intdigest(part.encode()) - 2**63)

        for text in b.column("text").to_pylist():
            c = codes(text or "")
            trigger = np.flatnonzero(is_digit(c) | (c == 64))
            if not len(trigger):
                if len(c):
                    add("plain", text, xxhash.xxh64_intdigest(text.encode()) % max(1, len(c) - TRAIN_LENGTH), [])
                continue
            spans = label_spans(text)
            # a number more than a window away from the last place taken
            places, last = [(k, s) for k, s, _ in spans], -TRAIN_LENGTH
            starts, ends = np.array([s for _, s, _ in spans]), np.array([e for _, _, e in spans])
            for t in trigger[np.diff(trigger, prepend=-2) > 1]:
                if t >= last + TRAIN_LENGTH and not ((starts - TRAIN_LENGTH < t) & (t < ends + TRAIN_LENGTH)).any():
                    places.append(("number", int(t)))
                    last = t
            for kind, p in places:
                add(kind, text, max(0, p - 8 - xxhash.xxh64_intdigest(f"{p}") % (TRAIN_LENGTH // 2)), spans)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(keys, pa.int64()), pa.array(texts, pa.string()), pa.array(rows, pa.binary())],
            ["kind", "key", "text", "tags"],
        )


def sample_windows(docs: DataFrame, per_kind: int = PER_KIND) -> list:
    """At most ``per_kind`` distinct windows of each kind, those of least hash."""
    found = docs.select("text").mapInArrow(window_batches, "kind string, key bigint, text string, tags binary")
    least = Window.partitionBy("kind").orderBy("key")
    rows = found.dropDuplicates(["kind", "key"]).withColumn("n", F.row_number().over(least)).where(F.col("n") <= per_kind)
    return sorted(rows.collect(), key=lambda r: (r["kind"], r["key"]))


def other_digits(text: str, rng) -> str:
    return "".join(str(rng.integers(0, 10)) if "0" <= ch <= "9" else ch for ch in text)


def training_set(rows: list, rng, n: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """(character classes, tags) of ``n`` windows made from the sampled ones."""
    real = [r for r in rows if any(r["tags"])]
    context = [r["text"] for r in rows if not any(r["tags"])] or [r["text"] for r in rows]
    words = [w.lower() for t in context for w in re.findall(r"[A-Za-z]{2,12}", t)] or ["name"]
    ids, tags = np.zeros((n, TRAIN_LENGTH), np.int16), np.zeros((n, TRAIN_LENGTH), np.int64)
    for i in range(n):
        kind = rng.random()
        if kind < 0.25 and real:
            r = real[int(rng.integers(0, len(real)))]
            text, t = other_digits(r["text"], rng), np.frombuffer(bytes(r["tags"]), np.int8)
        else:
            base = context[int(rng.integers(0, len(context)))]
            at = int(rng.integers(0, min(len(base), TRAIN_LENGTH - 40) + 1))
            left = base[:at].rstrip() + pii_planted.pick(rng, (" ", " ", ": ", " (", "\n")) if at else ""
            name = pii_planted.pick(rng, ("email", *KINDS)) if kind < 0.8 else None  # addresses have the most forms
            made = pii_planted.FORMS[name](rng, words, rng.random() < 0.5) if name else pii_planted.number(rng)
            text = (left + made + pii_planted.pick(rng, (" ", " ", ". ", ", ", ")", "\n")) + base[at:])[:TRAIN_LENGTH]
            t = tag_row(len(text), [(name, len(left), len(left) + len(made))] if name else [], 0)
        ids[i, : len(t)] = bilstm_crf.char_classes(codes(text))
        tags[i, : len(t)] = t
    return ids, tags


def train(docs: DataFrame, per_kind: int = PER_KIND, steps: int = STEPS, seed: int = 7):
    """Broadcast weights from the labelled windows of ``docs``; None where there is no text."""
    rows = sample_windows(docs, per_kind)
    if not rows:
        return None
    ids, tags = training_set(rows, np.random.default_rng(seed))
    return docs.sparkSession.sparkContext.broadcast(bilstm_crf.train(ids, tags, TAGS, steps, seed=seed))


def windows_of(n: int) -> np.ndarray:
    """Starts of the windows over n characters."""
    step = WINDOW - 2 * MARGIN
    return np.arange(0, max(1, n - 2 * MARGIN), step)


def triggers(c: np.ndarray) -> np.ndarray:
    """Characters that a span must hold one of: digits, "@", and the word "dot"."""
    out = is_digit(c) | (c == 64)
    if len(c) > 4:
        low = c | 32
        dot = (low[1:-3] == 100) & (low[2:-2] == 111) & (low[3:-1] == 116)
        edge = (low < 97) | (low > 122)
        out[1:-3] |= dot & edge[:-4] & edge[4:]
    return out


def stretches(c: np.ndarray) -> list[np.ndarray]:
    """Starts of the windows that hold a trigger, in groups of neighbours."""
    starts = windows_of(len(c))
    seen = np.concatenate([[0], np.cumsum(triggers(c))])
    has = starts[seen[np.minimum(starts + WINDOW, len(c))] > seen[starts]]
    return np.split(has, np.flatnonzero(np.diff(has) > WINDOW - 2 * MARGIN) + 1) if len(has) else []


def allowed_steps(trans: np.ndarray) -> np.ndarray:
    """Transitions without those that enter the inside of a span of another kind."""
    out = trans.copy()
    for inside in range(2, TAGS, 2):
        ok = np.isin(np.arange(TAGS), (inside - 1, inside))
        out[~ok, inside] = NEVER
    return out


class Stretch:
    """Scores of the characters from the first window's start to the last one's end, and what is still to come."""

    def __init__(self, doc: int, n: int, starts: np.ndarray):
        self.doc, self.n, self.low, self.high = doc, n, int(starts[0]), min(int(starts[-1]) + WINDOW, n)
        self.left = len(starts)
        self.sums, self.weight = np.zeros((self.high - self.low, TAGS), np.float32), np.zeros(self.high - self.low, np.float32)

    def add(self, start: int, scores: np.ndarray) -> None:
        end = min(start + WINDOW, self.n)
        at = np.arange(end - start)
        inside = np.minimum(at if start else WINDOW, end - start - 1 - at if end < self.n else WINDOW)  # the text's own ends are no edges
        w = np.broadcast_to(inside + 1, end - start).astype(np.float32)
        part = slice(start - self.low, end - self.low)
        self.sums[part] += scores[: end - start] * w[:, None]
        self.weight[part] += w
        self.left -= 1

    def scores(self) -> np.ndarray:
        return self.sums / self.weight[:, None]


def decoded(done: list[Stretch], trans: np.ndarray) -> list[np.ndarray]:
    """Tags of whole stretches, one decoding each."""
    out = []
    for at in range(0, len(done), 64):  # of similar length: a long one is not stacked with many short ones
        some = done[at : at + 64]
        lengths = np.array([s.high - s.low for s in some])
        e = np.zeros((lengths.max(), len(some), TAGS), np.float32)
        for i, s in enumerate(some):
            e[: lengths[i], i] = s.scores()
        first = np.stack([trans[OUTSIDE] if s.low else np.where(np.arange(TAGS) % 2 | (np.arange(TAGS) == 0), 0, NEVER) for s in some])
        last = np.stack([trans[:, OUTSIDE] if s.high < s.n else np.zeros(TAGS) for s in some])
        out += [p[:n] for p, n in zip(bilstm_crf.viterbi(e, trans, lengths, first, last), lengths, strict=True)]
    return out


def predicted(texts: list[np.ndarray], weights) -> list[list[tuple[str, int, int]]]:
    """Spans of the network over whole texts (as code points)."""
    out: list[list] = [[] for _ in texts]
    trans = allowed_steps(weights["t"])
    open_: list[Stretch] = []
    rows, jobs = [], []

    def flush():
        nonlocal open_
        if rows:
            scores = bilstm_crf.emissions(weights, np.stack(rows))
            for i, (stretch, start) in enumerate(jobs):
                stretch.add(start, scores[:, i])
            rows.clear()
            jobs.clear()
        done = sorted((s for s in open_ if not s.left), key=lambda s: s.high - s.low)
        open_ = [s for s in open_ if s.left]
        for s, tags in zip(done, decoded(done, trans), strict=True):
            begin = np.flatnonzero((tags % 2 == 1))
            for b in begin:
                e = b + 1
                while e < len(tags) and tags[e] == tags[b] + 1:
                    e += 1
                out[s.doc].append((KINDS[tags[b] // 2], s.low + int(b), s.low + int(e)))

    for d, c in enumerate(texts):
        for starts in stretches(c):
            stretch = Stretch(d, len(c), starts)
            open_.append(stretch)
            for s in starts.tolist():
                row = np.zeros(WINDOW, np.int16)
                row[: min(WINDOW, len(c) - s)] = bilstm_crf.char_classes(c[s : s + WINDOW])
                rows.append(row)
                jobs.append((stretch, s))
                if len(rows) == BATCH:
                    flush()
    flush()
    return [sorted(x, key=lambda y: y[1]) for x in out]


#: The words of an address, plain or spelt out: settles where a span found by the network begins and ends.
_AT = r"(?:@| @ |\s?[\[(]\s?at\s?[\])]\s?| at )"
_DOT = r"(?:\.| \. |\s?[\[(]\s?dot\s?[\])]\s?| dot )"
_ADDRESS = re.compile(rf"[\w%+-]+(?:\.[\w%+-]+)*{_AT}[\w-]+(?:{_DOT}[\w-]+)+", re.IGNORECASE)
NEAR = 64


def whole_address(text: str, s: int, e: int) -> tuple[int, int]:
    """The address that the span meets most of; the span itself where there is none."""
    low = max(0, s - NEAR)
    met = [(min(e, m.end() + low) - max(s, m.start() + low), m) for m in _ADDRESS.finditer(text[low : e + NEAR])]
    size, m = max(met, key=lambda x: x[0], default=(0, None))
    return (low + m.start(), low + m.end()) if size > 0 else (s, e)


def is_what_it_claims(kind: str, part: str) -> bool:
    numbers = re.findall("[0-9]+", part)
    n = sum(map(len, numbers))
    if kind == "email":
        return _ADDRESS.fullmatch(part) is not None
    if kind == "ip":
        return len(numbers) == 4 and all(len(x) < 4 and int(x) <= 255 for x in numbers)
    if kind == "card":
        return 13 <= n <= 19 and luhn("".join(numbers))
    return 9 <= n <= 15


def all_spans(texts: list[str], weights) -> list[tuple[list, list]]:
    """(rule spans, rule and added spans) of each text, by kind as listed, then start."""
    chars = [codes(t) for t in texts]
    rules = [base_spans(t) for t in texts]
    more = predicted(chars, weights) if weights is not None else [[]] * len(texts)
    out = []
    for text, c, base, new in zip(texts, chars, rules, more, strict=True):
        added = []
        for kind, s, e in new:
            while s < e and text[s] in " \n,;:":
                s += 1
            while s < e and text[e - 1] in " \n.,;:":
                e -= 1
            if s < e and kind != "email":  # a number is taken whole
                while s and is_digit(c[s - 1]) and is_digit(c[s]):
                    s -= 1
                while e < len(c) and is_digit(c[e]) and is_digit(c[e - 1]):
                    e += 1
            if s < e and kind == "email":
                s, e = whole_address(text, s, e)
            if s < e and is_what_it_claims(kind, text[s:e]) and not any(s < y and x < e for _, x, y in (*base, *added)):
                added.append((kind, s, e))
        out.append((base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1]))))
    return out


def find(docs: DataFrame, model) -> DataFrame:
    """doc_id, base and spans (arrays of kind:start:end) of every row of ``docs`` (doc_id, text)."""

    def run(batches):
        weights = model.value if model is not None else None
        for b in slices(batches, "text"):
            found = all_spans([t or "" for t in b.column("text").to_pylist()], weights)
            cols = [pa.array([[f"{k}:{s}:{e}" for k, s, e in x[i]] for x in found], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", "base", "spans"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, base array<string>, spans array<string>"
    )
