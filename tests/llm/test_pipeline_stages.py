"""corpus_pipeline: every stage against brute force on its own input."""

import collections

import pytest
from llm_cases import SCHEMA, alnum_words, edge_docs, edge_rows, no_docs, row, space_words
from test_llm_models import classes_by_hand
from test_llm_text import brute_hits, brute_lines

import corpus_pipeline
from fulfilq.llm import fertility

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """[(name, rows in, rows out)] over the smallest documents."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(i))
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_names_and_columns(stages):
    assert [s[0] for s in stages] == [n for n, _ in corpus_pipeline.STAGES] and len(stages) == 5
    for _, before, _, columns in stages[:4]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"] and before
    assert stages[4][3] == ["doc_id", "text", "lang", "source", "n_chars", "copy"]


def test_quality_stage(spark, stages):
    _, before, after, _ = stages[0]
    docs = spark.createDataFrame(before, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    keep = {r["doc_id"] for r in fertility.judge(fertility.measure(docs)).collect() if r["kept"]}
    assert {r["doc_id"] for r in after} == keep and 0 < len(keep) < len(before)


def test_line_stage(stages):
    _, before, after, _ = stages[1]
    want = brute_lines([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"]: r["text"] for r in after} == {k[0]: v[2] for k, v in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_near_stage(stages):
    _, before, after, _ = stages[2]
    of = classes_by_hand([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(of.values())) and len(after) < len(before)


def test_decontamination_stage(spark, stages):
    _, before, after, _ = stages[3]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for _, t in items for w in [alnum_words(t)] for i in range(max(1, len(w) - 9))}
    texts = {r["doc_id"]: r["text"] for r in after}

    def has(text):
        w = alnum_words(text)
        return any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))

    dirty = [r for r in before if has(r["text"])]
    assert dirty and not any(has(t) for t in texts.values())
    for r in before:
        if r not in dirty:
            assert texts[r["doc_id"]] == r["text"]
    r = dirty[0]
    n, n_hit, _ = brute_hits(r["text"], items)
    assert len(alnum_words(texts.get(r["doc_id"], ""))) <= n - n_hit


def test_mix_stage(stages):
    _, before, after, _ = stages[4]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before}
    n = collections.Counter(r["doc_id"] for r in after)
    assert max(n.values()) <= 3 and all({r["copy"] for r in after if r["doc_id"] == k} == set(range(1, v + 1)) for k, v in n.items())
    words = sum(len(space_words(r["text"])) for r in after)
    assert words == pytest.approx(sum(len(space_words(r["text"])) for r in before), rel=0.1)


def test_stages_take_edge_cases(spark, tmp_path):
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, edge_docs(spark), SF)
        assert out.columns[: len(SCHEMA.names)] == SCHEMA.names and out.count() <= 3 * len(edge_rows())
        out.write.parquet(str(tmp_path / str(i)))
        assert stage(spark, no_docs(spark), SF).count() == 0
    one = spark.createDataFrame([row(1, None, None, None)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, one, SF).count() in (0, 1)
