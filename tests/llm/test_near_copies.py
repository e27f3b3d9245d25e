"""The near-duplicate stage at its limit: copies that differ in one block, and texts on either side of 0.8."""

import numpy as np
import pytest

from tests.llm.test_record_operators import shingles
from tidemark.llm import simhash


def like(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def block_copies(n=120):
    """(text, longer text or cut one) of similarities from 0.80 to 0.85, of 300 shingles and more."""
    rng = np.random.default_rng(11)
    out = []
    for i in range(n):
        words = [f"d{i}w{x}" for x in rng.integers(0, 10 ** 6, 304 + int(rng.integers(0, 200)))]
        size = len(words) - 4                                   # shingles
        more = int(size / (0.8 + 0.05 * (i % 7) / 7)) - size    # 0.80 first
        new = [f"n{i}w{x}" for x in rng.integers(0, 10 ** 6, more)]
        a, b = " ".join(words), " ".join(words + new)
        assert 0.8 <= like(a, b) < 0.87
        out.append((a, b))
    return out


def test_appended_and_cut_copies_meet(spark):
    """Every pair that differs in one block, at 0.80 to 0.86, shares a bucket of the bands."""
    for a, b in block_copies():
        x, y = simhash.features(a), simhash.features(b)
        assert set(x[1].tolist()) & set(y[1].tolist())


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 7])
def test_block_copies_go_at_a_clear_distance(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        words = [f"d{i}w{x}" for x in rng.integers(0, 10 ** 6, 404)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + [f"n{i}w{x}" for x in range(44)]))]     # 0.9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(spark, docs).collect()) == list(range(0, 80, 2))


def brute_kept(rows):
    """Smallest doc_id of each group connected by pairs of 0.8 and more."""
    sets, top = {d: shingles(t) for d, t in rows}, {d: d for d, _ in rows}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 5 * both >= 4 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return sorted(d for d in sets if root(d) == d)


@pytest.mark.parametrize("rows_of_a_block", [simhash.EXACT_ROWS, 2])
def test_the_limit_is_exact(spark, monkeypatch, rows_of_a_block):
    """Pairs at exactly 0.8 are copies, those just below (0.76 to 0.799) are none; chains are connected."""
    monkeypatch.setattr(simhash, "EXACT_ROWS", rows_of_a_block)
    rng = np.random.default_rng(5)
    new = lambda n: [f"x{x}" for x in rng.integers(0, 10 ** 9, n)]
    rows = []
    for i in range(90):
        size = 400
        words = new(size + 4)
        more = 100 if i % 3 == 0 else 101 if i % 3 == 1 else 120        # 0.8, 0.798, 0.769
        rows += [(100 * i, " ".join(words)), (100 * i + 1, " ".join(words + new(more)))]
        if i % 9 == 1:              # a chain: each is a copy of the next only
            for k in range(2, 7):
                words = words[60:] + new(60 + (k == 2))
                rows.append((100 * i + k, " ".join(words)))
    kept = [r["doc_id"] for r in simhash.keep_one(spark, spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert sorted(kept) == brute_kept(rows)
    assert {100 * i + 1 for i in range(90) if i % 3 == 0}.isdisjoint(kept) and len(kept) >= 150


def test_stage_equals_exact_groups(spark):
    from tidemark.llm.common import table
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in simhash.keep_one(spark, docs).collect()) == brute_kept(rows)
