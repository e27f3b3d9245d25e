"""Importance resampling: brute force over whole tables and odd rows, the cutoff search, ranks over many ranges."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import resample as rs
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, score string, rank string, down string"


def features(text):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    runs = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(x.encode()) % 10_000 for x in runs]


def brute(docs, target, percent=25, min_words=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x)[1])
    for x in target:
        t.update(features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000)))) for b in range(10_000)]
    rows = []
    for i, x in docs:
        n, f = features(x)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    order = order[:percent * len(order) // 100]
    ranks = Counter()
    out = [(*r[:4], k) for k, r in enumerate(order, 1)]
    ranks.update(r for r in order)
    for r in rows:
        if ranks[r]:
            ranks[r] -= 1
        else:
            out.append((*r[:4], None))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    target = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    got = QUERIES["op12_resample"](spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target)


def odd():
    words = " ".join(f"Word{i} é{i}" for i in range(15))
    rows = [(1, None), (2, ""), (3, "?! -- \t"), (None, words), (None, words), (4, "x" * 300_000), (5, "A b c 1-2")]
    rows += [(9, words + " same")] * 40 + [(i, f"{words} {i} plain text of the target") for i in range(100, 130)]
    return rows


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_odd_rows_and_repeats_at_the_cutoff(spark, monkeypatch, piece):
    monkeypatch.setattr(rs, "PIECE", piece)
    docs, target = odd(), ["plain text of the target", None, ""]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in docs], DOC).repartition(4)
    for percent in (0, 1, 25, 60, 100):
        got = rs.resample(spark, df, spark.createDataFrame([(x,) for x in target], "text string"), percent=percent).collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(docs, target, percent)


def test_empty_tables(spark):
    none, texts = spark.createDataFrame([], DOC), spark.createDataFrame([("a b",)], "text string")
    assert rs.resample(spark, none, texts).collect() == []
    one = spark.createDataFrame([(1, "a b", "", "", "")], DOC)
    assert [tuple(r) for r in rs.resample(spark, one, texts.filter("false"), min_words=1, percent=100).collect()] == brute(
        [(1, "a b")], [], 100, 1)


def test_ranks_over_many_ranges(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), int(s)) for i, s in zip(rng.permutation(5000), rng.integers(0, 40, 5000))] + [(7, 20)] * 2000 + [(None, 20)]
    df = spark.createDataFrame(rows, "doc_id bigint, score bigint").repartition(5)
    got = rs.ranked(spark, df, len(rows), per_range=100)
    assert got.count() == len(rows)
    order = sorted(rows, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
    assert [(r["doc_id"], r["score"]) for r in sorted(got.collect(), key=lambda r: r["rank"])] == order
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, len(rows) + 1))
    for want in (0, 1, 500, 3500, 4200, len(rows) - 1, len(rows), len(rows) + 5):
        n = df.filter(rs.cutoff(df, want)).collect()
        assert sorted({tuple(r) for r in n}, key=str) == sorted(set(order[:want]), key=str)


@pytest.mark.parametrize("values, want", [([5], 1), ([-2 ** 63, 2 ** 63 - 1, 0], 2), ([3, 3, 3], 2), ([1, 2], 3)])
def test_smallest_finds_the_exact_number(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert rs._smallest(df, "v", want) == (sorted(values)[want - 1] if want <= len(values) else None)
