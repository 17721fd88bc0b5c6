"""Texts of any length and kind go through the tokenizers whole."""

import random

import pytest
from llm_cases import BASE, SCHEMA, row, space_words

from fulfilq.llm import fertility, length_histogram, tokenizers


@pytest.fixture(scope="module")
def encoding():
    class Local:
        value = open(f"{tokenizers.FOLDER}/{fertility.RANKS}", "rb").read()

    return tokenizers.rank_encoder(Local, fertility.RANKS)


def test_cut_runs_give_the_plain_tokens(encoding, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(tokenizers, "LONG_RUN", 3)
    monkeypatch.setattr(tokenizers, "_LONG", tokenizers.re.compile(f"[{tokenizers.SPACES}]{{3,}}"))
    parts = ["a", "It's", "é漢", "12", "#!", "'s", "\x1c\x1f", "​", " ", "  ", "   ", "\n\n\n", " \t \r\n", "\xa0　 ", "\x85\x85\x85", "\x0b\x0c ", "    "]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert tokenizers.encode_ordinary(encoding, text) == encoding.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("gap", [" ", "\n", " \n", "　"])
def test_runs_that_the_matcher_can_take_give_its_tokens(encoding, gap):
    for text in (f"a b{gap * 100_000}c", gap * 100_000, f"{gap * 100_000}'s", f"x{gap * 70_000}1 {gap * 70_000}"):
        assert tokenizers.encode_ordinary(encoding, text) == encoding.encode_ordinary(text)


def test_five_million_of_one_character(spark):
    n = 5_000_000
    texts = ["a b " + " " * n + "c", "\n" * n, "a" * n, "#" * n, "é " + "\t" * n + BASE, " ".join([BASE] * 300) + " " * n]
    docs = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r["doc_id"]: r for r in fertility.measure(docs).collect()}
    assert [got[i]["n_words"] for i in range(6)] == [len(space_words(t)) for t in texts]
    lengths = {r["doc_id"]: r["n_tokens"] for r in length_histogram.lengths(docs).collect()}
    assert lengths == {i: got[i]["n_tokens"] for i in range(6)} and lengths[1] > 1000
    kept = fertility.reject(docs).collect()
    assert {r["doc_id"] for r in kept} <= {4, 5}
