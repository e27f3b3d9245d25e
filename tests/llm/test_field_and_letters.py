"""Secrets beyond the base patterns on a whole table, linear search, samples without ids; letters of op10; ties of op4."""

import random
import time
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_text_operators import DOC
from tests.oracle_compare import duck
from tidemark.llm import chat, langid, secrets
from tidemark.llm.common import table

MIXED = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def foreign_secret(r):
    """Forms that neither the base patterns nor the training's variations know by name."""
    k = r.randrange(4)
    return ("ghp_" + "".join(r.choices(MIXED, k=36)) + "7" if k == 0 else
            "xoxb-" + "".join(r.choices("0123456789", k=12)) + "-" + "".join(r.choices(MIXED, k=24)) if k == 1 else
            "eyJ" + "".join(r.choices(MIXED + "_", k=60)) + "4" if k == 2 else "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=31)) + "5")


def test_field_finds_planted_secrets_in_a_whole_table(spark):
    """Precision and recall of the field over all documents of sf0.01, half with a secret, half with a harmless long token."""
    rng, rows, planted = random.Random(9), [], {}
    words = ["alpha", "green", "house", "river", "table"]
    for r in table(spark, "/root/testdata/sf0.01", "documents").orderBy("doc_id").collect():
        text = (r["text"] or "").split(" ")
        at, real = rng.randrange(len(text) + 1), rng.random() < 0.5
        token = foreign_secret(rng) if real else secrets.harmless(rng, words)
        before = " ".join([*text[:at], rng.choice(["key", "is", "=", "bearer", "use"])]) + " "
        rows.append((r["doc_id"], before + token + " " + " ".join(text[at:])))
        planted[r["doc_id"]] = (len(before), len(before) + len(token), real)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: r for r in secrets.scan(docs, secrets.train(docs)).collect()}
    hits = wrong = real = 0
    for d, (a, z, is_real) in planted.items():
        spans = [s.split(":") for s in found[d]["spans"].split(",") if s]
        field = [(int(s[1]), int(s[2])) for s in spans if s[0] == secrets.FIELD]
        near = [s for s in field if s[0] < z and a < s[1]]
        base = any(int(s[1]) < z and a < int(s[2]) for s in spans if s[0] != secrets.FIELD)
        real += is_real and not base
        hits += bool(near) and is_real and not base
        wrong += len(field) - (len(near) if is_real else 0)
    assert real > 300 and hits / real >= 0.9 and hits / (hits + wrong) >= 0.9, (hits, real, wrong)
    assert sum(r["n_field"] for r in found.values()) >= hits


@pytest.mark.parametrize("text", ["=" * 1_000_000, "-" * 1_000_000, "a" * 999_999 + "-", "0123456789abcdef " * 60_000,
                                  "password = Abcdef1234567890 " * 20_000])
def test_long_lines_take_linear_time(text):
    field = secrets.Field(np.zeros((secrets.DIM, 3)), np.zeros((3, 3)))
    start = time.perf_counter()
    secrets.all_spans(text, secrets.base_spans(text), field)
    secrets.lessons(text)
    assert time.perf_counter() - start < 20


def test_field_spans_inside_base_spans_equal_a_search(monkeypatch):
    rng = random.Random(1)
    for _ in range(200):
        spans = lambda kinds, n: sorted((rng.choice(kinds), a, a + rng.randint(1, 9)) for a in rng.choices(range(40), k=n))
        base = sorted(spans(secrets.KINDS, 6), key=lambda s: (s[1], secrets.KINDS.index(s[0])))
        more = spans((secrets.FIELD,), 6)

        class Some:
            def spans(self, text, more=more):
                return more
        got = secrets.all_spans("", base, Some())
        want = [s for s in more if not any(a <= s[1] and s[2] <= z for _, a, z in base)]
        assert sorted(got) == sorted(base + want)


def test_rows_without_ids_are_drawn_like_others(spark):
    """With null or equal ids the sample stays near its bound, and a repeated row counts once."""
    rows = [(None, f"line {i} token = {i:032x} end", None, None, 0) for i in range(300)]
    rows += [(None, "the same row token = 00112233445566778899aabbccddeeff", None, None, 0)] * 300
    docs = spark.createDataFrame(rows, DOC)
    field = secrets.train(docs, max_training=100)
    assert field is not None and field.spans("x token = 0123456789abcdef0123456789abcdef y")
    assert secrets.train(docs.filter("false")) is None


def test_variations_keep_tags_legal():
    line = "the words before token = 0123456789abcdef0123 and after"
    tokens, starts = secrets.tokenize(line)
    tags = secrets.labels(tokens, starts, secrets.base_spans(line))
    made = secrets.variations(line, tokens, starts, tags, 0, len(tokens))
    assert [sum(t == secrets.B for t in own) for _, own in made] == [1, 0] * secrets.VARIATIONS
    for new, own in made:
        legal = secrets.allowed(new)
        assert all(legal[i, t] for i, t in enumerate(own)) and not any(secrets.ASSIGN_NAME.search(t) for t, x in zip(new, own) if x == secrets.O)
    assert made == secrets.variations(line, tokens, starts, tags, 0, len(tokens))
    assert secrets.variations(line, tokens, starts, [0] * len(tags), 0, len(tokens)) == []


# ---- letters of the language model --------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(categories=["No", "Nl", "Nd", "Lo", "Lu", "Ll", "So", "Sm", "Po", "Zs", "Mn"]), max_size=12))
def test_a_letter_is_what_unicode_says(text):
    letter = any(unicodedata.category(c).startswith("L") for c in text)
    assert langid.has_letter(text) == letter
    low = text.lower()
    blank = "".join(c if unicodedata.category(c).startswith("L") else "!" for c in low)
    assert (langid.counts(text) == langid.counts(blank)).all()


def test_letterless_texts_are_undetermined(spark):
    texts = ["² ½", "Ⅷ ①", "、。「」", "😀 😀", "", None, "1234", "²a"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    model = langid.Model(["en"], np.ones(langid.DIM), np.zeros((langid.DIM + 1, 1)))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs, model).collect()}
    assert [got[i] for i in range(7)] == [("und", 0.0)] * 7 and got[7][0] == "en"


# ---- ties of the chat format ------------------------------------------------------------

def test_equal_turns_are_ordered_as_the_sql_orders_them(spark, tmp_path):
    rows = [(1, 0, "user", t) for t in ("<a", "Aa", "\\x", ">", "]", "zz", "", None, "é", "<")] + [(1, 0, "assistant", "<"), (1, None, None, "n")]
    rows += [(None, 2, "user", "b"), (None, 2, "user", "<b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/c")
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/c/*.parquet')")
    want = {r[0]: r for r in con.sql(chat.SQL).fetchall() if r[0] != -7}
    from pyspark.sql import functions as F
    got = chat.digest(chat.format_conversations(df.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))))
    columns = con.sql(chat.SQL).columns
    assert {r["conv_id"]: tuple(r[c] for c in columns) for r in got.collect()} == want
