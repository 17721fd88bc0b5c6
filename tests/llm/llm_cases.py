"""Small tables shared by the tests of the training-data operators, and plain helpers."""

from __future__ import annotations

import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("n_words", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("size", T.LongType()),
        T.StructField("token", T.StringType()),
    ]
)

BASE = " ".join(f"word{i % 97}x{i}" for i in range(400))


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text) if text is not None else None, "extra", "n", True, 7, "t")


def edge_rows():
    near = BASE.replace("word5x5 ", "other ").replace("word90x90 ", "changed ")
    long = "\n".join(f"line number {i} of a very long text {i * 7919 % 10007}" for i in range(20_000))
    return [
        row(1, BASE),
        row(1, BASE),  # a repeated row
        row(2, BASE),  # an exact copy
        row(3, near),
        row(4, None),
        row(5, ""),
        row(6, ""),
        row(None, "a text without an id, " * 3, "de", "b"),
        row(7, long, None, None),
        row(8, "one\ntwo\n\n" + BASE[:700] + "\nA shared line of words\n", "fr", "b"),
        row(9, "A shared line of words\n  a SHARED line of words \nother\n", "fr", None),
        row(10, "Öl ß\x0b\x0c\r\t é", "xx", "b"),
    ]


def edge_docs(spark, parts=3):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(parts)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
