"""The pipeline's near-duplicate stage takes its candidates from SimHash too."""

import numpy as np

from tests.llm.test_near_copies import brute_kept
from tidemark.llm import simhash


def copies_of(n):
    """(doc_id, text): texts of 400 words, and each once more with its last word changed, which moves few bits."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 10 ** 6, 400)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[:-1], f"last{i}"]))]
    return rows


def test_linked_fingerprints_are_candidates(spark, monkeypatch):
    """Without any band, the pairs that SimHash links are found all the same."""
    monkeypatch.setattr(simhash, "candidates", lambda reps: spark.createDataFrame([], "a bigint, b bigint"))
    rows = copies_of(30)
    near = {d for d, t in rows if d % 2 and (simhash.fingerprint(t) ^ simhash.fingerprint(dict(rows)[d - 1])).bit_count() <= 4}
    assert len(near) > 20
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["doc_id"] for r in simhash.keep_one(spark, docs).collect()} == {d for d, _ in rows} - near


def test_links_alone_do_not_decide(spark, monkeypatch):
    """Texts of equal fingerprints that are no copies stay, as brute force says."""
    monkeypatch.setattr(simhash, "fingerprint", lambda *_: 5)
    rows = copies_of(12)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(spark, docs).collect()) == brute_kept(rows)
