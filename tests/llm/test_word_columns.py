"""Columns of words against the words one by one, and the counts beside a word that comes from many batches."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_class_lm import DOC, odd
from tests.llm.test_whole_classes import compare
from tidemark.llm import classlm as lm


def texts():
    rng = random.Random(3)
    return [None, "", " \t", "x" * 40 + " " + "é" * 30, *("".join(rng.choices("abZ09.-é中 \t\n\x0b\x0c\r\x1c\x00\x85　#", k=k)) for k in range(300))]


def test_columns_equal_word_lists():
    words, sizes = lm.split_words(pa.array(texts()))
    want = [[w for some in lm.word_lists(t) for w in some] for t in texts()]
    assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert lm.keys(words).to_pylist() == [lm.key(w) for t in want for w in t]
    assert lm.shapes_of(words).tolist() == [lm.shape(w) for t in want for w in t]


@pytest.mark.parametrize("block", [1, 100, 1 << 25])
def test_blocks_hold_every_text_once(monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK", block)
    column = pa.array(texts()).slice(2)
    got = [*lm.blocks(column)]
    assert [t for b in got for t in b.to_pylist()] == column.to_pylist()
    assert all(len(b) == 1 or sum(len((t or "").encode()) for t in b.to_pylist()) <= block for b in got)
    assert [*lm.blocks(pa.array([], pa.string()))] == []


def test_contexts_are_one_row_per_word_of_a_batch(spark):
    """The same rare word in many texts leaves a task once, with all its counts."""
    docs = spark.createDataFrame([(1, f"rare{i % 3} w{i % 40} rare{i % 3}") for i in range(200)], "doc_id bigint, text string").coalesce(1)
    nothing = lm.Words([], np.zeros(0, np.int64), np.zeros(0, np.int64), 200, 800, 44, np.zeros(lm.SHAPES, np.int64))
    of = np.concatenate([np.zeros(lm.CLUSTERED, np.int64), lm.CLASSES + np.arange(lm.SHAPES + 1)])
    rows = lm.contexts(lm.code_texts(docs, nothing), nothing, of).collect()
    assert sorted(bytes(r["word"]) for r in rows) == sorted({w.encode() for i in range(200) for w in (f"rare{i % 3}", f"w{i % 40}")})
    assert sum(int((np.frombuffer(r["counts"], "<i8") >> lm.CODE_BITS).sum()) for r in rows) == 600


@pytest.mark.parametrize("batch", [1, 2, 3, 10_000])
def test_a_word_of_many_batches_is_asked_once(spark, batch):
    rng = np.random.default_rng(2)
    m = rng.poisson(20, (lm.C, lm.C)) + 40
    counts = {w: [(int(rng.integers(0, (lm.C + 1) ** 2)), int(rng.integers(1, 4))) for _ in range(k)]
              for w, k in ((b"a", 1), (b"b", 9), (b"c", 2), (b"d", 7), (b"e", 1))}
    counts[b"b"] += counts[b"b"][:3]
    pack = lambda x: np.array([n << lm.CODE_BITS | c for c, n in x], "<i8").tobytes()
    schema = "word binary, shape int, looked boolean, counts binary"
    whole = [(w, 1, False, pack(x)) for w, x in counts.items()]
    parts = [(w, 1, False, pack([x])) for w, xs in counts.items() for x in xs]
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, batch)
    try:
        got = [sorted(map(tuple, lm.choose_classes(spark.createDataFrame(r, schema).coalesce(1), m).collect())) for r in (whole, parts)]
    finally:
        spark.conf.set(key, old)
    assert got[0] == got[1] and [(bytes(r[0]), r[3]) for r in got[0]] == [(w, sum(n for _, n in x)) for w, x in counts.items()]


def test_scores_from_small_batches(spark, monkeypatch):
    monkeypatch.setattr(lm, "LOOKUP", 4)
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, 3)
    try:
        compare(spark, monkeypatch, spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in odd()], DOC).repartition(2), odd())
    finally:
        spark.conf.set(key, old)
