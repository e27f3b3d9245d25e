"""The field learns what it meets: file features of whole texts, and lines of any length."""

import numpy as np

from tidemark.llm import secrets

KEY = "9f86d081884c7d65ab12"
PROSE = "plain words of a page " * 60


def test_file_features_are_those_of_the_whole_text(monkeypatch):
    text = "{ a = b; }\n" * 300 + f"token = {KEY}\n" + "plain words\n" * 300
    seen = []
    own = secrets.token_features
    monkeypatch.setattr(secrets, "token_features", lambda t, i, f: seen.append(tuple(f)) or own(t, i, f))
    batch = next(secrets._with_lines(iter([secrets.pa.record_batch(
        {"doc_id": secrets.pa.array([1, 2], secrets.pa.int64()), "text": [text, "no such token"]})])))
    assert batch.column("doc_id").to_pylist() == [1]
    secrets.learn(batch.column("text").to_pylist(), epochs=1, of_files=[x.split(" ") for x in batch.column("of_file").to_pylist()])
    assert set(seen) == {tuple(secrets.file_features(text))}


def test_long_lines_teach():
    line = PROSE + f"token = {KEY} " + PROSE
    assert len(line) > 400
    w, step, n = secrets.learn([line])
    assert n >= 1 and np.abs(w).sum() > 0
    assert sum(z - a for _, a, z in secrets.lessons(line)) == len(secrets.tokenize(line)[0])


def test_a_stretch_does_not_begin_inside_a_secret(monkeypatch):
    monkeypatch.setattr(secrets, "STRETCH", 3)
    tags = [0, 0, 1, 2, 2, 0, 0, 0, 1]
    assert list(secrets.stretches(["x"] * 9, tags)) == [(0, 5), (5, 8), (8, 9)]


def test_a_document_teaches_a_bounded_sample():
    text = "\n".join(f"x{k} token = {KEY}{k}" for k in range(500))
    some = secrets.lessons(text)
    assert len(some) == secrets.STRETCHES and some == secrets.lessons(text) and some[-1][0] > len(text) // 2


def test_a_shard_learns_a_bounded_sample(monkeypatch):
    monkeypatch.setattr(secrets, "MAX_STRETCHES", 5)
    texts = [f"t{k} token = {KEY}{k}\nsecret: {KEY}{k}{k}" for k in range(20)]
    assert secrets.learn(texts, epochs=1)[2] == 5


def test_a_longer_span_of_the_field_is_masked_whole():
    text = "key 9f86d081884c7d65_ZxQ82LmP04sTqW and " + KEY
    base = secrets.base_spans(text)
    assert base[0] == ("hex", 4, 20)

    class Tagged:
        def spans(self, _):
            return [(secrets.FIELD, 4, 35), (secrets.FIELD, *base[1][1:])]
    spans = secrets.all_spans(text, base, Tagged())
    assert spans == [base[0], (secrets.FIELD, 4, 35), base[1]]
    assert secrets.masked(text, spans) == "key [SECRET] and [SECRET]"
