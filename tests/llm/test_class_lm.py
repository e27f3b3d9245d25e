"""Class language model: base scores by brute force, exchange against whole recounts, probabilities that sum to one."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import classlm as lm
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, rid string, word string, n string, shape string, base string"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", low)] + [lm.END]


def learned(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def brute_base(docs):
    c = Counter(w for i, t in docs if learned(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in docs:
        own = tokens(t)
        out.append((i, i is not None and not learned(i), len(own), sum(c[w] > 0 for w in own), n,
                    sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)))
    return out


def brute_model(docs, model):
    """The model's score of every text, token by token from its classes and the corpus' own counts."""
    words = [w for i, t in docs if learned(i) for w in tokens(t)]
    c = Counter(words)
    top = {w: u for u, w in enumerate(model.words.words[:model.words.clustered()])}
    cls = lambda w: (lm.CLASSES + lm.SHAPES if w == lm.END else int(model.of[top[lm.key(w)]]) if lm.key(w) in top
                     else lm.CLASSES + lm.shape(w))
    pairs, after = Counter(), Counter()
    for i, t in docs:
        if learned(i):
            seq = [cls(w) for w in [lm.END, *tokens(t)]]
            pairs.update(zip(seq, seq[1:]))
            after.update(seq[1:])
    before = Counter()
    for (a, _), k in pairs.items():
        before[a] += k
    total, k = sum(after.values()), lm.CLASSES + lm.SHAPES + 1
    distinct = Counter(cls(w) for w in c)
    out = []
    for _, t in docs:
        score, last = 0.0, lm.CLASSES + lm.SHAPES
        for w in tokens(t):
            x = cls(w)
            share = (after[x] + 0.1) / (total + 0.1 * k)
            score += math.log10((pairs[last, x] + share) / (before[last] + 1))
            if w != lm.END:
                score += math.log10(c[w] / after[x] if x < lm.CLASSES else (c[w] + 0.1) / (after[x] + 0.1 * (distinct[x] + 1)))
            last = x
        out.append(score)
    return out


def check(got, docs, model):
    base, score = brute_base(docs), brute_model(docs, model)
    got = sorted((tuple(r) for r in got), key=str)
    want = sorted(((*b, s) for b, s in zip(base, score)), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[:5]), round(r[5], 6), round(r[6], 6))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and \
            math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9), (g, w)


COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("look_up", [1 << 17, 300])
def test_whole_table_equals_brute_force(spark, monkeypatch, look_up):
    monkeypatch.setattr(lm, "LOOKUP", look_up)
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = lm.train(spark, docs, rounds=2)
    check(lm.score(spark, docs, model).select(*COLUMNS).collect(), [tuple(r) for r in docs.collect()], model)
    assert model.likelihoods[1] > model.likelihoods[0] and len(model.words.words) < look_up + 1


def odd():
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "never learned é"), (4, "word " * 200_000), (5, "x" * 400_000),
            (6, "A b 12 --- É   x\x85y " + "=" * 40), (6, "A b 12 --- É   x\x85y " + "=" * 40), (7, "b a b a c")]
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    return rows + [(held, "unheard words b " + "unheard " * 50), (held, None)]


@pytest.mark.parametrize("piece", [1 << 20, 11])
def test_odd_texts(spark, monkeypatch, piece):
    monkeypatch.setattr(lm, "PIECE", piece)
    monkeypatch.setattr(lm, "FLUSH", 3 if piece == 11 else 1 << 20)
    monkeypatch.setattr(lm, "LOOKUP", 4)
    docs = [r for r in odd() if piece > 11 or len(r[1] or "") < 1000]
    df = spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in docs], DOC).repartition(3)
    model = lm.train(spark, df, rounds=2)
    check(lm.score(spark, df, model).select(*COLUMNS).collect(), docs, model)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], DOC)
    model = lm.train(spark, none, rounds=1)
    assert lm.score(spark, none, model).collect() == []
    df = spark.createDataFrame([(None, "a b", "", "", "", "", "")], DOC)
    r = lm.score(spark, df, model).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] < 0


def test_query_beats_the_base_on_held_out_texts(spark):
    got = QUERIES["op13_class_lm"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    n = sum(r["n_tokens"] for r in got)
    assert len(got) > 50 and sum(r["score"] for r in got) / n > sum(r["base_score"] for r in got) / n + 0.1
    assert all(math.isclose(r["perplexity"], 10 ** (-r["score"] / r["n_tokens"])) for r in got)


def test_probabilities_sum_to_one(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model = lm.train(spark, docs, rounds=1)
    assert np.allclose((10 ** model.transitions()).sum(1), 1)
    m = model.words.clustered()
    own = np.bincount(model.of[:m], 10 ** model.emissions()[:m], lm.CLASSES)
    assert np.allclose(own[model.tokens_of_class()[:lm.CLASSES] > 0], 1)
    rest = np.bincount(model.words.shapes[m:], model.words.n[m:], lm.SHAPES)
    assert (rest == model.tokens_of_class()[lm.CLASSES:-1]).all()          # sf0.001 looks every word up
    assert np.allclose(rest + lm.EXTRA * (model.unclustered() + 1), model.shape_total())


def test_exchange_gain_equals_a_recount():
    rng = np.random.default_rng(4)
    u, c = 60, lm.CLASSES + lm.SHAPES + 1
    n = rng.poisson(0.4, (u, u))
    of = rng.integers(0, 8, u)
    matrix = lambda of: np.bincount((of[:, None] * c + of[None, :]).ravel(), n.ravel(), c * c).reshape(c, c).astype(np.int64)
    for x in range(20):
        after, before = np.bincount(of, n[x], c), np.bincount(of, n[:, x], c)
        to, gain = lm.best_class(matrix(of), of[x], after, before, int(n[x, x]))
        found = []
        for k in range(lm.CLASSES):
            other = of.copy()
            other[x] = k
            found.append(lm.likelihood(matrix(other)))
        assert math.isclose(max(found) - lm.likelihood(matrix(of)), gain, abs_tol=1e-6) and math.isclose(found[to], max(found), abs_tol=1e-6)
