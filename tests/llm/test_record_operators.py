"""WARC, SimHash, token files, packing and the pipeline: round trips, brute force, edge cases."""

import collections
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import CLASHING, DOC, brute_spans, odd_documents
from tests.oracle_compare import duck
from tidemark.llm import packing, quality, rans, simhash, tokens, warc
from tidemark.llm.common import table
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.vocabulary_path(), limit=50)


# ---- WARC ------------------------------------------------------------------

def test_archives_reject_magic_in_payloads(spark, tmp_dir, monkeypatch):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    long = "<p>ü" * 400
    rows = [(1, "http://a/", "x" + fake + "WARC/1.1\r\n" + fake), (2, None, None), (3, "http://b/é\n", fake), (4, "u", long), (5, "u", long),
            (9, "u", long), (6, "u", ""), (7, "u", "x" * 999), (8, "u", "x" * 999), (10, "u", fake * 3000), (None, "u", "null id"),
            (11, "u", "\r\n\r\nWARC/1.1\r\n"), (12, "u", "WARC/1.1\r\nContent-Length: 99999999\r\n\r\n"), (9, "u", long)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, row string")
    warc.write(pages.repartition(2), f"{tmp_dir}/a", records_per_file=4)
    found = warc.candidates(spark, f"{tmp_dir}/a")
    assert found.count() > 14 and len(found.select("file").distinct().collect()) >= 4
    out = warc.records(spark, f"{tmp_dir}/a").collect()
    assert len(out) == 14
    html = collections.defaultdict(set)
    for p, _, h in rows:
        html[p].add((h or "").encode())
    for r in out:
        (body,) = html[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha1(body).hexdigest())
        assert (r["payload"] is None) == (r["record_type"] == "revisit") and (r["payload"] in (None, body))
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in out if r["page_id"] in (4, 5, 7, 8, 9)}
    assert kinds == {(4, "revisit", 9), (5, "revisit", 9), (9, "response", None), (7, "response", None), (8, "response", None)}


def test_archives_of_nothing_and_broken_ones(spark, tmp_dir):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write(pages, f"{tmp_dir}/none")
    assert warc.records(spark, f"{tmp_dir}/none").count() == 0
    warc.write(spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], pages.schema).coalesce(1), f"{tmp_dir}/b")
    import glob
    (name,) = glob.glob(f"{tmp_dir}/b/*.txt")
    data = open(name, "rb").read()
    (tmp := __import__("pathlib").Path(tmp_dir) / "cut").mkdir()
    (tmp / "x.txt").write_bytes(data[:-3])
    with pytest.raises(ValueError):
        warc.records(spark, str(tmp))
    assert warc.records(spark, str(tmp), strict=False).count() == 1


def test_pointer_jumping_equals_walking(spark):
    rng = np.random.default_rng(2)
    rows, want = [], set()
    for f in "abc":
        at = sorted({0, *rng.integers(1, 5000, 120).tolist()})
        nxt = {a: (int(rng.choice([x for x in at if x > a])) if a != at[-1] else None) for a in at}
        x = 0
        while x is not None:
            want.add((f, x))
            x = nxt[x]
        rows += [(f, a, b) for a, b in nxt.items()]
    got = warc.reachable(spark, spark.createDataFrame(rows, "file string, at bigint, next bigint"))
    assert {tuple(r) for r in got.collect()} == want


# ---- SimHash ----------------------------------------------------------------

def brute_fingerprint(text):
    import re

    import xxhash
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(prints, distance=4):
    top = {i: i for i in prints}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    ids = sorted(prints)
    v = np.array([prints[i] for i in ids], np.uint64)
    for a in range(len(ids)):
        for b in np.flatnonzero(np.bitwise_count(v[a] ^ v) <= distance):
            x, y = root(ids[a]), root(ids[int(b)])
            top[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_groups_equal_brute_force(spark):
    prints = {d: brute_fingerprint(t) for d, t in duck(SF).sql("SELECT doc_id, text FROM documents").fetchall()}
    want = brute_groups(prints)
    got = QUERIES["op2_simhash_groups"](spark, SF).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints
    assert {r["doc_id"]: r["component_id"] for r in got} == want


@pytest.mark.parametrize("n,distance", [(1_000, 4), (3_000_000, 4), (10 ** 9, 4), (1_000, 2)])
def test_links_are_complete_for_any_plan(spark, n, distance):
    """Whatever partitions the plan picks (here for tables of different sizes), all links are found."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(8)]
    fps = sorted({x - (1 << 64) if x >= 1 << 63 else x for x in [*map(int, base), *near, 0]})
    df = spark.createDataFrame([(x,) for x in fps], "fp bigint")
    _, m = simhash.moments(df)
    parts = simhash.plan(n, m, distance)
    assert sum(r + 1 for _, r in parts) == distance + 1 and len({b for bits, _ in parts for b in bits}) == sum(len(b) for b, _ in parts)
    want = {(a, b) for a in fps for b in fps if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance}
    assert {tuple(r) for r in simhash.links(df, distance, parts).collect()} == want


def test_simhash_edge_cases(spark):
    docs = odd_documents(spark).withColumns({"fp": F.lit(1), "component": F.lit("x")})
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(spark, docs).collect()]
    assert len(got) == 7 and got.count(got[[g[0] for g in got].index(5)]) == 2
    assert {g for g in got if g[0] in (1, 2, 3)} == {(i, "0" * 16, 1) for i in (1, 2, 3)}
    assert next(g for g in got if g[0] is None)[2] is None
    assert simhash.near_duplicates(spark, docs.filter("false")).count() == 0
    for t in ("", "a", "A b C", "a b c d", "a b c d e é\u00a0f", "x " * 50):
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_components_of_a_chain_a_star_and_repeats(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7), (None, 3), (5, 4), (5, 4)]
    got = {r["node"]: r["component"] for r in components(spark, spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(t, k=5):
    w = (t or "").lower().split()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def near_copy_table(spark, n=40):
    rng = np.random.default_rng(9)
    rows, base = [], ["w%d" % x for x in rng.integers(0, 9000, 300)]
    for i in range(n):                                  # one large group of near copies of row 0
        w = list(base)
        if i:
            w[int(rng.integers(300))] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join("v%d" % x for x in rng.integers(0, 9000, 200))) for i in range(60)]
    rows += [(2000 + i, rows[50][1]) for i in range(30)] + [(None, rows[50][1]), (3000, None), (3001, None), (3002, "a b")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rid", F.lit("mine"))


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 7])
def test_one_document_of_each_group_stays(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)      # with 7, the buckets of the large group are split
    docs = near_copy_table(spark)
    out = simhash.keep_one(spark, docs)
    assert out.schema.simpleString() == docs.schema.simpleString()
    assert sorted(r["doc_id"] for r in out.collect()) == [0, *range(1000, 1060), 3000, 3002]
    assert simhash.keep_one(spark, docs.filter("false")).count() == 0


# ---- token files ----------------------------------------------------------------

@given(st.lists(st.text(alphabet=" \n\t\u00a0\u3000aZ'stveé中.1-*#ƶß×\u0301", max_size=30), max_size=8))
@settings(max_examples=500, deadline=None)
def test_encoder_equals_the_library(texts):
    global _ENC
    enc = globals().setdefault("_ENC", tokens.Encoder(tokens.vocabulary_path(), limit=50))
    assert enc.encode(texts) == enc.direct(texts)


@given(st.lists(st.integers(0, 40), max_size=900), st.integers(1, 9))
@settings(max_examples=60, deadline=None)
def test_rans_round_trip(ids, every):
    ids = np.array(ids, np.uint32) ** 2
    model = rans.Model(rans.scale(np.bincount(ids, minlength=2000)))
    block = rans.encode(ids, model, every)
    assert (rans.decode(block, model) == ids).all()
    steps = -(-len(ids) // rans._lanes(len(ids)))
    parts = [rans.decode(block, model, k) for k in range(-(-steps // every))]
    assert (np.concatenate([np.zeros(0, np.uint32), *parts]) == ids).all()


def test_rans_detects_damage():
    ids = np.random.default_rng(0).integers(0, 900, 5000).astype(np.uint32)
    model = rans.Model(rans.scale(np.bincount(ids, minlength=1000)))
    block = rans.encode(ids, model)
    for bad in (block[:-4], block[:10], b"XXXX" + block[4:], block[:-5] + bytes([block[-5] ^ 1]) + block[-4:]):
        with pytest.raises(ValueError):
            rans.decode(bad, model)
    size = rans.stretch_size(rans.encode(ids, model, 4))
    block = rans.encode(ids, model, 4)
    for at in range(len(block) - 4, 200, -997):         # in a word or a checkpoint, whatever stretch it belongs to
        bad, wrong = block[:at] + bytes([block[at] ^ 1]) + block[at + 1:], 0
        for k in range(-(-len(ids) // size)):
            try:
                assert (rans.decode(bad, model, k) == ids[k * size:(k + 1) * size]).all()
            except ValueError:
                wrong += 1
        assert wrong
    assert rans.scale(np.zeros(5, int)).sum() == 0
    many = rans.scale(np.array([10 ** 12] + [1] * 50_000))
    assert many.sum() == 1 << rans.PROB_BITS and many.min() == 1


def check_token_rows(rows, docs, encoder, end):
    """Rows of the reader against direct encoding in (doc_id, text) order."""
    at, want = 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = encoder.direct([t or ""])[0] + np.array([end], "<u4").tobytes()
        want.append((d, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(rows, key=lambda r: r[1]) == want


def test_token_files_equal_direct_encoding(spark, encoder):
    rows = [tuple(r) for r in QUERIES["op5_rans_token_files"](spark, SF).collect()]
    check_token_rows(rows, duck(SF).sql("SELECT doc_id, text FROM documents").fetchall(), encoder, 0)


def test_token_file_edge_cases(spark, tmp_dir, encoder):
    docs = odd_documents(spark).withColumns({"shard": F.lit("x"), "ids": F.lit(1)})
    rans.write(spark, docs, f"{tmp_dir}/t", tokens.vocabulary_path(), partitions=3)
    got = rans.read(spark, f"{tmp_dir}/t").select("doc_id", "start", "n_tokens", "ids_crc32")
    check_token_rows([tuple(r) for r in got.collect()], [(r["doc_id"], r["text"]) for r in docs.collect()], encoder, 0)
    rans.write(spark, docs.filter("false"), f"{tmp_dir}/none", tokens.vocabulary_path())
    assert rans.read(spark, f"{tmp_dir}/none").count() == 0


def test_null_ids_and_repeated_rows_are_many_shards(spark, tmp_dir, encoder):
    docs = spark.range(3000).selectExpr("cast(if(id % 3 = 0, null, 5) as bigint) doc_id",
                                        "if(id % 2 = 0, 'one text', concat('text ', id)) text")
    rans.write(spark, docs, f"{tmp_dir}/t", tokens.vocabulary_path(), partitions=6)
    sizes = [r["n"] for r in spark.read.parquet(f"{tmp_dir}/t/blocks").groupBy("shard")
             .agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) < 1000
    got = rans.read(spark, f"{tmp_dir}/t").select("doc_id", "start", "n_tokens", "ids_crc32")
    check_token_rows([tuple(r) for r in got.collect()], [(r["doc_id"], r["text"]) for r in docs.collect()], encoder, 0)


def test_spans_are_read_by_stretches(spark, tmp_dir, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rans.write(spark, docs, f"{tmp_dir}/t", tokens.vocabulary_path(), partitions=5)
    rows = rans.read(spark, f"{tmp_dir}/t").select("start", "ids").collect()
    whole = b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["start"]))
    n = len(whole) // 4
    for a, z in ((0, n), (0, 1), (n - 1, n + 50), (n // 3, n // 3 + 7), (n // 5, n - n // 5), (7, 7), (n, n + 9)):
        parts = sorted(rans.read_span(spark, f"{tmp_dir}/t", a, z).collect(), key=lambda r: r["start"])
        assert b"".join(p["ids"] for p in parts) == whole[4 * a:4 * z]
        assert not parts or parts[0]["start"] == a
    rans.write(spark, docs.filter("false"), f"{tmp_dir}/none", tokens.vocabulary_path())
    assert rans.read_span(spark, f"{tmp_dir}/none", 0, 5).collect() == []


# ---- packing ---------------------------------------------------------------------

def check_pieces(rows, texts, encoder, end=1):
    """texts: (doc_id, text) with unique ids. Every id in one piece, sequences gapless; returns the padding."""
    of, seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append(r)
    assert set(of) == {d for d, _ in texts}
    for d, t in texts:
        ids, at = encoder.direct([t or ""])[0] + np.array([end], "<u4").tobytes(), 0
        for r in sorted(of[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids) // 4
            assert r["ids_crc32"] == zlib.crc32(ids[4 * at:4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids) // 4
    padding = 0
    for pieces in seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
        padding += packing.WINDOW - at if at & (at - 1) else 0
    return padding


def test_packing_covers_every_id_once(spark, encoder):
    rows = QUERIES["op6_nnls_packing"](spark, SF).collect()
    assert check_pieces(rows, duck(SF).sql("SELECT doc_id, text FROM documents").fetchall(), encoder) < packing.WINDOW


def test_packing_edge_cases(spark, encoder):
    docs = odd_documents(spark).filter("doc_id is null or doc_id <> 5").withColumns({"g": F.lit("x"), "row": F.lit(1)})
    rows = packing.pack_documents(docs, tokens.vocabulary_path(), group_docs=2).collect()
    check_pieces(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], encoder)
    twice = packing.pack_documents(odd_documents(spark).filter("doc_id = 5"), tokens.vocabulary_path()).collect()
    assert len(twice) == 2 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 2
    assert packing.pack_documents(docs.filter("false"), tokens.vocabulary_path()).count() == 0


@given(st.lists(st.integers(1, 6000), max_size=200))
@settings(max_examples=60, deadline=None)
def test_pack_is_a_partition_with_one_open_window(sizes):
    windows = packing.pack(sizes)
    cover = collections.defaultdict(list)
    for w in windows:
        assert 0 < sum(n for *_, n in w) <= packing.WINDOW
        for d, start, n in w:
            cover[d].append((start, n))
    for d, size in enumerate(sizes):
        at = 0
        for start, n in sorted(cover[d]):
            assert start == at and n > 0
            at += n
        assert at == size
    assert sum(sum(n for *_, n in w) < packing.WINDOW for w in windows) <= 1


def test_nnls_meets_its_conditions_and_patterns_fill_a_window():
    shapes = packing.patterns()
    assert ((shapes * np.arange(1, packing.BINS + 1)).sum(axis=1) == packing.BINS).all()
    assert shapes.sum(axis=1).max() == packing.PARTS and len({tuple(r) for r in shapes}) == len(shapes)
    rng = np.random.default_rng(0)
    for _ in range(5):
        a, b = shapes[rng.choice(len(shapes), 200, replace=False)].T, rng.poisson(40, packing.BINS).astype(float)
        x = packing.nnls(a, b)
        slope = a.T @ (b - a @ x)
        assert (x >= 0).all() and slope.max() < 1e-5 and np.abs(slope[x > 0]).max(initial=0) < 1e-5


# ---- pipeline ----------------------------------------------------------------------

def test_stages_equal_brute_force(spark, encoder):
    docs, columns = table(spark, SF, "documents"), table(spark, SF, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "packing"]
    rows = {r["doc_id"]: r for r in docs.collect()}
    items = [" ".join((t or "").lower().split()) for (t,) in duck(SF).sql("SELECT text FROM benchmark").fetchall()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs, _ = corpus_pipeline.written(spark, stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        now = {r["doc_id"]: r for r in docs.collect()}
        if name == "quality_rules":
            fails = lambda t: any(eval(c.replace("AND", "and"), {}, dict(zip(quality.MEASURES, quality.measure(t))))  # noqa: E731, S307
                                  for c in quality.RULES.values())
            assert set(now) == {d for d, r in rows.items() if not fails(r["text"])}
        elif name == "near_duplicates":
            s = {d: shingles(r["text"]) for d, r in rows.items()}
            like = lambda a, b: len(s[a] & s[b]) / len(s[a] | s[b])
            gone = set(rows) - set(now)
            assert all(max(like(d, e) for e in rows if e != d) >= 0.7 for d in gone)
            kept = sorted(now)
            assert not [1 for i, a in enumerate(kept) for b in kept[i + 1:] if like(a, b) >= 0.87]
        elif name == "decontamination":
            assert set(now) == {d for d, r in rows.items() if not any(i in " ".join((r["text"] or "").lower().split()) for i in items)}
        else:
            assert set(now) == set(rows)
            for d, r in rows.items():
                assert not brute_spans(now[d]["text"] or "") and (now[d]["text"] == r["text"]) == (not brute_spans(r["text"] or ""))
                assert now[d]["n_chars"] == len(now[d]["text"])
        rows = now
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert check_pieces(out, [(d, r["text"]) for d, r in rows.items()], encoder) < packing.WINDOW
    whole = QUERIES.get("pipeline", corpus_pipeline.run)(spark, SF).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, out))


def test_pipeline_takes_odd_and_empty_tables(spark):
    good = " ".join(f"word{i}x" for i in range(70))
    odd = odd_documents(spark).unionByName(spark.createDataFrame([(None, good, None, None, None), (8, good + " end", "en", "s", 5)], DOC))
    for docs, n in ((odd, 1), (odd.filter("false"), 0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs, _ = corpus_pipeline.written(spark, stage(spark, docs, SF), "odd")
            assert docs.columns == odd.columns
        assert docs.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == n
    extra = spark.createDataFrame([(1, good, "d", "m", "f", 7, 8, "k", "l", "x")], CLASHING)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        extra = stage(spark, extra, SF)
    assert tuple(extra.first()) == (1, good, "d", "m", "f", 7, 8, "k", "l", "x")
