"""License scan by exact set-similarity join (operator 5).

Text blocks (sentences and lines) and notice templates are token sets. A
template T is found in a block B when at least ``need(T)`` of its tokens, 0.8
of them rounded up, are in B. Template tokens are put in global order of
frequency, rarest first, counted over all blocks of all documents. Such a block
must hold one of the first |T| - need(T) + 1 tokens (prefix filter), have at
least need(T) distinct tokens (length filter), and, from its first common token
on, leave room for need(T) in both ordered sets (positional filter). The pairs
that remain are counted exactly, so the join loses none.

With ``across_lines`` (the registered query) a block also goes on over single
line breaks, up to an empty line or the end of a sentence. There the 0.8 must be
met in one line, as without it, or within ``SPAN`` times the notice's number of
words, so a wrapped notice is found at any width and a long list of lines does
not add up to one. The filters run on the whole block, which holds both. A template
may name words that such a line or stretch must hold beside the 0.8 (the
licence's name), or must not hold (those that make it another licence).

DataFrame functions only. Null or empty text: no words, no labels, score 0.
Repeated rows: one result row each. No rows: no result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulfilq.llm.common import ascii_lower

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK_END = r"\n|[.!?][ \t]"
#: An empty line, or the end of a sentence; "v. 2.0" is none.
BREAK = r"\n[ \t\r]*\n|[.!?](?:[ \t]|\r?\n)(?![ \t\r\n]*[0-9])"
#: Twice a notice's words: each may come with one of its own, such as a comment mark.
SPAN = 2
THRESHOLD = 0.8
#: phrase -> label, found as consecutive words.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: (label, notice, words it must have, words it must not have): short public licence notices; the list is a
#: parameter of the scan, the last two may be left out. The words that name a licence are not among the 0.2
#: of a notice that may be missing.
TEMPLATES = (
    ("mit", "released under the MIT License", ("mit",)),
    ("mit", "permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "licensed under the Apache License, Version 2.0", ("apache",)),
    ("gpl", "licensed under the GNU General Public License, version 3", ("gnu",)),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License", ("gnu",)),
    ("bsd", "released under the BSD License", ("bsd",)),
    ("bsd", "redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla",)),
    ("cc-by-nc", "licensed under CC BY-NC 4.0", ("cc", "nc")),
    ("cc-by-sa", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ("commons", "sharealike")),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License", ("commons", "attribution"),
     ("sharealike", "noncommercial", "noderivatives")),
    ("cc-by", "licensed under CC BY 4.0", ("cc", "by"), ("nc", "sa", "nd")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered",)),
)
#: Templates are a parameter; their tokens stay literals of the plan up to this bound.
MOST_TOKENS = 20_000


def notice_words(notice: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), notice))


def template_sets(templates=TEMPLATES) -> list[tuple[str, list[str]]]:
    out = [(label, sorted(set(notice_words(notice)))) for label, notice, *_ in templates]
    if sum(len(t) for _, t in out) > MOST_TOKENS:
        raise ValueError(f"templates hold more than {MOST_TOKENS} tokens; scan in several calls")
    return out


def named(templates=TEMPLATES) -> list[tuple[tuple[str, ...], tuple[str, ...]]]:
    """Per template the words that a place must hold, and those that it must not."""
    return [(tuple((rest[0] if rest else ())), tuple((rest[1] if len(rest) > 1 else ()))) for _, _, *rest in templates]


def need(n: int, threshold: float = THRESHOLD) -> int:
    return max(1, math.ceil(n * threshold - 1e-9))


def words(col: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(col), GAP), "")


def blocks(docs: DataFrame, across_lines: bool = False) -> DataFrame:
    """(doc, row, tokens): the distinct words of every block that has some; doc and row are the document's key.

    ``across_lines`` adds the block's text as ``block``.
    """
    # token arrays leave the generator, below which no filter on them is pushed: each block is split once
    if across_lines:
        parts = F.transform(
            F.split("text", BREAK), lambda block: F.struct(block.alias("block"), F.array_distinct(words(block)).alias("tokens"))
        )
        return docs.select("doc", "row", F.inline(parts)).where(F.size("tokens") > 0)
    tokens = F.explode(F.transform(F.split("text", BLOCK_END), lambda block: F.array_distinct(words(block))))
    return docs.select("doc", "row", tokens.alias("tokens")).where(F.size("tokens") > 0)


def fits(part: Column, must: Column, never: Column) -> Column:
    """All words of ``must`` and none of ``never`` are in ``part``."""
    return (F.size(F.array_except(must, part)) == 0) & ~F.arrays_overlap(never, part)


def closest(block: Column, t: Column, span: Column, must: Column, never: Column) -> Column:
    """Most tokens of ``t`` in one line of ``block``, or in ``span`` consecutive words of it; 0 where the line or words don't fit."""

    def held(part):
        return F.when(fits(part, must, never), F.size(F.array_intersect(t, part))).otherwise(0)

    def let(value, use):
        # the value is computed once, not in every step of the loops inside
        return F.element_at(F.transform(F.array(value), use), 1)

    def spans(w):
        starts = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: F.array_contains(t, F.element_at(w, i)))
        return F.array_max(F.transform(starts, lambda i: held(F.slice(w, i, span))))

    def best(lines):
        return F.greatest(F.array_max(F.transform(lines, held)), let(F.flatten(lines), spans))

    return let(F.transform(F.split(block, BLOCK_END), words), best)


def frequencies(b: DataFrame, sets) -> dict[str, int]:
    """Blocks that hold each template token, over all blocks."""
    every = sorted({t for _, tokens in sets for t in tokens})
    known = F.array(*[F.lit(t) for t in every])
    hit = b.select(F.explode(F.array_intersect("tokens", known)).alias("token"))
    found = {r["token"]: r["n"] for r in hit.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: found.get(t, 0) for t in every}


def matches(b: DataFrame, sets, threshold: float = THRESHOLD, spans: list[int] | None = None, names=None) -> DataFrame:
    """(doc, row, label, containment) of every block and template that meet the threshold.

    ``spans``: words of each template within which blocks across lines must meet it.
    ``names``: the words of each template that must be there, and those that must not.
    """
    names = names or [((), ())] * len(sets)

    def words_of(some):
        return F.array(*map(F.lit, some)).cast("array<string>")

    freq = frequencies(b, sets)
    order = {t: i for i, t in enumerate(sorted(freq, key=lambda t: (freq[t], t)))}
    index = []
    for k, (label, tokens) in enumerate(sets):
        tokens = sorted(tokens, key=order.get)
        least = need(len(tokens), threshold)
        for i, token in enumerate(tokens[: len(tokens) - least + 1]):
            index.append((token, k, label, i, least, tokens))
    if not index:
        return b.select("doc", "row", F.lit("").alias("label"), F.lit(0.0).alias("containment")).where(F.lit(False))
    rows = [
        F.struct(
            F.lit(token).alias("token"), F.lit(k).alias("template"), F.lit(label).alias("label"),
            F.lit(i).alias("at"), F.lit(least).alias("least"), F.array(*map(F.lit, tokens)).alias("t"),
            F.lit(spans[k] if spans else 0).alias("span"),
            words_of(names[k][0]).alias("must"), words_of(names[k][1]).alias("never"),
        )
        for token, k, label, i, least, tokens in index
    ]
    # bounded by MOST_TOKENS, whatever the corpus holds
    prefix = b.sparkSession.range(1).select(F.inline(F.array(*rows)))
    rare = F.array(*[F.lit(t) for t in sorted({r[0] for r in index})])
    known = F.array(*[F.lit(t) for t in sorted(order, key=order.get)])
    some = b.where(F.arrays_overlap("tokens", rare))
    some = some.withColumns(
        {
            "size": F.size("tokens"),
            # the block's template tokens in global order; tokens of no template cannot be common
            "b": F.array_intersect(known, F.col("tokens")),
        }
    )
    hits = some.withColumn("token", F.explode(F.array_intersect("tokens", rare)))
    pairs = hits.join(F.broadcast(prefix), "token").where(F.col("size") >= F.col("least"))
    # a pair is met once, at its first common token
    common = F.array_intersect("t", "b")
    pairs = pairs.where(F.element_at(common, 1) == F.col("token"))
    room = 1 + F.least(F.size("t") - F.col("at") - 1, F.size("b") - F.array_position("b", F.col("token")).cast("int"))
    pairs = pairs.where(room >= F.col("least"))
    pairs = pairs.where(F.size(common) >= F.col("least"))
    pairs = pairs.where(F.size(F.array_except("must", "tokens")) == 0)
    if not spans:
        pairs = pairs.where(~F.arrays_overlap("never", "tokens"))
        return pairs.select("doc", "row", "label", (F.size(common) / F.size("t")).alias("containment"))
    # a generator again: only the pairs that are left are counted, and once
    n = F.explode(F.array(closest(*map(F.col, ("block", "t", "span", "must", "never")))))
    pairs = pairs.select("doc", "row", "label", "least", F.size("t").alias("size"), n.alias("n"))
    return pairs.where(F.col("n") >= F.col("least")).select("doc", "row", "label", (F.col("n") / F.col("size")).alias("containment"))


def phrase_places(s: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, start of the first, words after the start of the last) in text ``s`` of words, two blanks between and around them."""
    p = "  ".join(["", *phrase.split(), ""])[1:-1]
    has = F.contains(s, F.lit(p))
    n = F.when(has, ((F.length(s) - F.length(F.replace(s, F.lit(p), F.lit("")))) / len(p)).cast("bigint")).otherwise(0)

    def in_part(x):
        return F.floor((F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))) / 2)

    first = F.when(has, in_part(F.substring_index(s, p, 1)))
    last = F.when(has, in_part(F.substring_index(s, p, -1)) + len(phrase.split()))
    return n, first, last


def scan(
    docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, across_lines: bool = False
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): places of the phrases, labels of phrases and templates, score.

    ``score`` is 1 where a phrase was found, else the best containment found, else 0.
    ``across_lines`` also finds notices that are wrapped over several lines.
    """
    sets = template_sets(templates)
    d = docs.select(
        F.col("doc_id").cast("bigint").alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    spans = [SPAN * len(notice_words(notice)) for _, notice, *_ in templates] if across_lines else None
    found = matches(blocks(d, across_lines), sets, threshold, spans, named(templates))
    found = found.groupBy(F.col("doc").alias("d"), F.col("row").alias("r")).agg(
        F.collect_set("label").alias("own"), F.max("containment").alias("best")
    )
    single = F.trim(F.regexp_replace(ascii_lower(F.col("text")), GAP, " "))
    spaced = F.concat(F.lit("  "), F.replace(single, F.lit(" "), F.lit("  ")), F.lit("  "))
    d = d.select("doc", "row", F.when(single == "", "").otherwise(spaced).alias("s"))
    blanks = F.length("s") - F.length(F.replace("s", F.lit(" "), F.lit("")))
    places = {label: phrase_places(F.col("s"), p) for p, label in phrases.items()}
    n_words = F.when(F.col("s") == "", 0).otherwise(blanks / 2 - 1).cast("bigint")
    base = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for label, (n, _, _) in places.items()]))
    d = d.select(
        "doc",
        "row",
        n_words.alias("n_words"),
        sum((n for n, _, _ in places.values()), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min(F.array(*[f for _, f, _ in places.values()])).cast("bigint").alias("first_word"),
        F.array_min(F.array(*[x for _, _, x in places.values()])).cast("bigint").alias("to_end"),
        base.alias("base"),
    )
    d = d.join(found, F.col("doc").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")
    none = F.array().cast("array<string>")
    return d.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        (F.col("n_words") - F.col("to_end")).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("own", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
