"""Benchmark text that was copied word by word is found, whatever its slots and its length."""

import numpy as np

from tidemark.llm import decontaminate

rng = np.random.default_rng(8)
WORDS = [f"word{chr(97 + x // 26 % 26)}{chr(97 + x % 26)}" for x in range(600)]
PROSE = " ".join(rng.choice(WORDS, 60))
# 60 words, the number 17 three times, of which the copy alters one.
LONG = " ".join(("17" if k in (8, 30, 50) else w) for k, w in enumerate(rng.choice(WORDS, 60).tolist()))
ONE_OFF = " ".join("23" if k == 30 else w for k, w in enumerate(LONG.split()))
# Two values that become equal.
PAIR = " ".join({5: "11", 6: "12", 40: "11", 41: "12"}.get(k, w) for k, w in enumerate(rng.choice(WORDS, 50).tolist()))
EQUAL = " ".join("11" if w == "12" and k == 41 else w for k, w in enumerate(PAIR.split()))
SUMS = "12 + 7 = 19 and 3 5 8 13 21 34 55 89"            # nearly all numbers
TITLE = "das Haus Der Alten Frau Im Dunklen Wald Bei Der Stadt"
SHORT = "qwertz asdfgh"


def found(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(spark, docs, bench).collect()}


def test_verbatim_text_is_found(spark):
    items = [LONG, PAIR, SUMS, TITLE, SHORT]
    texts = [f"{PROSE} {x} {PROSE}" for x in (ONE_OFF, EQUAL, SUMS, TITLE, SHORT, "qwertz and asdfgh")]
    got = found(spark, texts, items)
    assert set(got) == {(k, k) for k in range(5)}
    assert got[0, 0]["kind"] == "reparameterised" and 0.7 < got[0, 0]["coverage"] < 1
    assert 0.7 < got[1, 1]["coverage"] < 1
    assert [(got[k, k]["kind"], got[k, k]["coverage"]) for k in (2, 3, 4)] == [("verbatim", 1.0)] * 3


def test_other_sums_are_no_leak(spark):
    assert not found(spark, [f"{PROSE} 4 + 9 = 13 and 2 6 7 14 20 33 54 88 {PROSE}"], [SUMS])


def test_a_shift_counts_window_by_window():
    same, off = (["17", "3"], ["17", "3"], [0, 1]), (["17"], ["19"], [9])
    again = (["17"], ["17"], [5])
    assert decontaminate.consistent([same, again, off]) == [True, True, False]
    new, more = (["17", "4"], ["18", "5"], [0, 1]), (["17"], ["18"], [5])
    assert decontaminate.consistent([new, more, off]) == [True, True, False]
    assert decontaminate.consistent([(["1", "2"], ["9", "9"], [0, 1])]) == [False]
    assert decontaminate.consistent([([], [], [])]) == [True]
