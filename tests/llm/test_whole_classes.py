"""Word classes for every word: the gains against whole recounts, scores by brute force, rare words of one use together."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_class_lm import COLUMNS, DOC, SF, brute_base, learned, odd, tokens
from tidemark.llm import classlm as lm
from tidemark.llm.common import table


def test_gains_of_many_words_equal_a_recount():
    rng = np.random.default_rng(6)
    u = 80
    n = rng.poisson(0.3, (u, u))
    of = rng.integers(0, 8, u)
    asked = np.arange(20)
    of[asked] = lm.CLASSES + rng.integers(0, 3, 20)
    matrix = lambda of: np.bincount((of[:, None] * lm.C + of[None, :]).ravel(), n.ravel(), lm.C ** 2).reshape(lm.C, lm.C)
    side = lambda x, counts: np.bincount(np.delete(of, x), np.delete(counts, x), lm.C)
    to, gain = lm.best_classes(matrix(of), of[asked], np.array([side(x, n[x]) for x in asked]),
                               np.array([side(x, n[:, x]) for x in asked]), n[asked, asked].astype(float))
    for x in asked:
        found = []
        for k in range(lm.CLASSES):
            other = of.copy()
            other[x] = k
            found.append(lm.likelihood(matrix(other)))
        stay = lm.likelihood(matrix(of))
        assert math.isclose(max(found) - stay, gain[x], abs_tol=1e-6) and math.isclose(found[to[x]], max(found), abs_tol=1e-6)


def brute_scores(docs, cls):
    """Scores token by token, given the class of every word."""
    words = [w for i, t in docs if learned(i) for w in tokens(t)]
    c, pairs = Counter(words), Counter()
    for i, t in docs:
        if learned(i):
            seq = [cls(w) for w in [lm.END, *tokens(t)]]
            pairs.update(zip(seq, seq[1:]))
    after, before = Counter(), Counter()
    for (a, b), k in pairs.items():
        after[b] += k
        before[a] += k
    total, distinct = sum(after.values()), Counter(cls(w) for w in c)
    out = []
    for _, t in docs:
        score, last = 0.0, lm.C - 1
        for w in tokens(t):
            x = cls(w)
            score += math.log10((pairs[last, x] + (after[x] + 0.1) / (total + 0.1 * lm.C)) / (before[last] + 1))
            if w != lm.END:
                score += math.log10(c[w] / after[x] if x < lm.CLASSES else (c[w] + 0.1) / (after[x] + 0.1 * (distinct[x] + 1)))
            last = x
        out.append(score)
    return out


def compare(spark, monkeypatch, df, docs):
    """The query's rows against brute force, with the classes that the words were given."""
    held = {}
    chosen = lm._class_texts

    def noted(coded, found, words, place_class, base_total):
        held.clear()
        held.update({w: int(k) for w, k in zip(words.words, place_class)})
        held.update({bytes(r["word"]): r["class"] for r in found.collect()})
        return chosen(coded, found, words, place_class, base_total)
    monkeypatch.setattr(lm, "_class_texts", noted)
    model = lm.train_whole(spark, df, rounds=2)
    got = lm.score_whole(model).select(*COLUMNS).collect()
    cls = lambda w: lm.C - 1 if w == lm.END else held.get(lm.key(w), lm.CLASSES + lm.shape(w))
    order = lambda r: (str(r[:5]), round(r[5], 6), round(r[6], 6))
    want = sorted(((*b, s) for b, s in zip(brute_base(docs), brute_scores(docs, cls))), key=order)
    got = sorted((tuple(r) for r in got), key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and \
            math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9), (g, w)
    return model, held


@pytest.mark.parametrize("look_up", [1 << 17, 300])
def test_whole_table_equals_brute_force(spark, monkeypatch, look_up):
    monkeypatch.setattr(lm, "LOOKUP", look_up)
    docs = table(spark, SF, "documents").select("doc_id", "text")
    model, held = compare(spark, monkeypatch, docs, [tuple(r) for r in docs.collect()])
    others = [w for w in held if w not in set(model.words.words[:model.words.clustered()])]
    # every word of the training texts was asked; many have a class now, and the likelihood is better for it
    assert len(held) == model.words.distinct - 1
    assert look_up > 300 or sum(held[w] < lm.CLASSES for w in others) > len(others) / 4
    assert model.likelihoods[-1] >= max(model.likelihoods[:-1]) - 1e-6


@pytest.mark.parametrize("piece", [1 << 20, 11])
def test_odd_texts(spark, monkeypatch, piece):
    monkeypatch.setattr(lm, "PIECE", piece)
    monkeypatch.setattr(lm, "LOOKUP", 4)
    docs = [r for r in odd() if piece > 11 or len(r[1] or "") < 1000]
    compare(spark, monkeypatch, spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in docs], DOC).repartition(3), docs)


def test_nothing_to_learn_from(spark):
    assert lm.score_whole(lm.train_whole(spark, spark.createDataFrame([], DOC), rounds=1)).collect() == []
    df = spark.createDataFrame([(None, "a b", "", "", "", "", "")], DOC)
    r = lm.score_whole(lm.train_whole(spark, df, rounds=1)).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (3, 0, 0, 0.0) and r["score"] < 0


def test_rare_words_of_one_use_share_a_class(spark, monkeypatch):
    """Words too rare to be looked up, of one shape, in two uses: their classes tell the uses apart."""
    monkeypatch.setattr(lm, "LOOKUP", 6)
    names, verbs = [f"aaname{chr(97 + i)}" for i in range(20)], [f"bbverb{chr(97 + i)}" for i in range(20)]
    ids = [i for i in range(800) if zlib.crc32(str(i).encode()) % 10 != 0][:400]
    docs = [(d, f"the {names[i % 20]} will {verbs[(i // 20) % 20]} here the {names[0]} will {verbs[0]} here") for i, d in enumerate(ids)]
    _, held = compare(spark, monkeypatch, spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in docs], DOC), docs)
    names, verbs = {held[w.encode()] for w in names}, {held[w.encode()] for w in verbs}
    assert not names & verbs and max(names | verbs) < lm.CLASSES
