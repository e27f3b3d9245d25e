"""Token ids are those of an untouched tokenizer, also where a text holds an added token's string."""

import json
import zlib
from array import array

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, rans, tokens

PATH = tokens.vocabulary_path()
with open(PATH) as _f:
    ADDED = [t["content"] for t in json.load(_f)["added_tokens"]]
PLAIN = Tokenizer.from_file(PATH)
_ENC = tokens.Encoder(PATH, limit=50)
TEXTS = [f"a {ADDED[0]} b", ADDED[0], f"one two{ADDED[0]}  three four", "no such text", f" {ADDED[0]} {ADDED[0]}\n x"]


def plain(text):
    return array("I", PLAIN.encode(text, add_special_tokens=False).ids).tobytes()


def test_added_token_is_one_id():
    assert list(array("I", _ENC.encode([TEXTS[0]])[0])) == PLAIN.encode(TEXTS[0], add_special_tokens=False).ids
    assert PLAIN.token_to_id(ADDED[0]) in array("I", _ENC.encode([TEXTS[0]])[0])


@given(st.lists(st.lists(st.sampled_from([*ADDED, ADDED[0][:-1], ADDED[0][1:], " ", "  ", "a", "bc's", "é", "\n", "12"]),
                         max_size=9).map("".join), max_size=6))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_an_untouched_tokenizer(texts):
    assert _ENC.encode(texts, b"end.") == [plain(t) + b"end." for t in texts]


def test_queries_hold_the_ids_of_an_untouched_tokenizer(spark, tmp_dir):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    rans.write(spark, docs, f"{tmp_dir}/t", PATH)
    at, want = 0, []
    for d, t in enumerate(TEXTS):
        ids = plain(t) + np.array([0], "<u4").tobytes()
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = rans.read(spark, f"{tmp_dir}/t").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
    packed = packing.pack_documents(docs, PATH, end_id=0).collect()
    assert {(r["doc_id"], r["doc_tokens"]) for r in packed} == {(d, n) for d, _, n, _ in want}
