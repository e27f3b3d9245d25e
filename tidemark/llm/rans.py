"""Token-id files coded with a static range asymmetric numeral system.

Layout of a written file set (all parts are Spark tables, so any file system
works, a failed task leaves nothing behind and a lost executor costs a retry):

* ``table``: symbol, frequency. One frequency table over all ids of all
  documents, scaled to 2**PROB_BITS; shared by every block.
* ``blocks``: one row per block: shard, the shard's ids before it, the doc_ids
  and lengths it holds in ascending doc_id order, and ``payload``, an independent
  rANS stream.

A payload starts with magic, number of ids, lanes, steps between checkpoints and
number of 32-bit words. Then come the checkpoints at every ``every`` steps (word
position, CRC-32 of the ids up to the next checkpoint, lane states) and the words.
Lane j of step i holds id i * lanes + j. Any stretch between two checkpoints decodes
and is checked without the rest, so both blocks and stretches decode in parallel:
``read`` decodes blocks, ``read_span`` only the stretches that hold a range of ids.

Scale: documents are range-partitioned once, by doc_id, the text's first characters and hash and the
row's place in the input, so that neither null ids nor repeated rows make one large shard. Sampling
the ranges reads texts but tokenizes nothing, as ids are made after the shuffle. The
tokenizing task counts its ids, so no pass over the ids is needed for the frequencies. ``start`` needs one
sum per shard (a shard is one range partition); within a shard the writer counts.
A block holds whole documents, about ``block_ids`` ids, or one longer document.

Defined results: a null or empty text is a document of only the end id; equal
doc_ids (repeated rows) keep one entry each, in the order of their texts (of the first
``PREFIX`` characters, then of a hash); a null doc_id comes first; an empty table gives an empty file set, readable as such; extra
columns are ignored. A damaged payload raises ValueError, in a stretch as in a block.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import remove, table, written
from tidemark.session import scratch_path

PROB_BITS = 18
BLOCK_IDS = 1 << 20
PREFIX = 32
EVERY = 128                    # steps between checkpoints
_LOW = np.uint64(1 << 31)      # states stay in [2**31, 2**63)
_HEAD = struct.Struct("<4sIIII")
_POINT = struct.Struct("<II")
_MAGIC = b"RNS2"
_32 = np.uint64(32)
_M = np.uint64(PROB_BITS)


class Model:
    """The shared frequency table, ready for coding."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(63 - PROB_BITS)
        self._symbol: np.ndarray | None = None

    @property
    def symbol(self) -> np.ndarray:
        """The symbol of every slot."""
        if self._symbol is None:
            kind = np.uint16 if len(self.freq) <= 1 << 16 else np.uint32
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))
        return self._symbol


def scale(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**PROB_BITS, at least 1 for every symbol that occurs."""
    total, size = int(counts.sum()), 1 << PROB_BITS
    if not total:
        return np.zeros(len(counts), np.int64)
    if int((counts > 0).sum()) > size:
        raise ValueError("more symbols than slots")
    exact = counts.astype(np.float64) * (size / total)
    freq = np.where(counts > 0, np.maximum(1, np.floor(exact)), 0).astype(np.int64)
    rest = size - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if rest > 0:                                   # what rounding down left over
        freq[order[0]] += rest
    for s in order:                                # what raising rare symbols to 1 took too much
        if rest >= 0:
            break
        give = min(-rest, int(freq[s]) // 2)
        freq[s] -= give
        rest += give
    return freq


def _lanes(n: int) -> int:
    return 1 << max(0, min(12, (max(n, 1) // 64).bit_length() - 1))


def encode(ids: np.ndarray, model: Model, every: int = EVERY) -> bytes:
    n, lanes = len(ids), _lanes(len(ids))
    steps = -(-n // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    out: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []       # words still to come before the step, states there
    done = 0
    for i in range(steps - 1, -1, -1):
        s = ids[i * lanes:(i + 1) * lanes]
        k = len(s)
        x, f = state[:k], model.freq[s]
        full = x >= model.limit[s]
        if full.any():
            words = x[full].astype(np.uint32)      # the low half
            out.append(words)
            done += len(words)
            x = np.where(full, x >> _32, x)
        q = x // f
        state[:k] = (q << _M) + (x - q * f) + model.start[s]
        if i % every == 0:
            marks.append((done, state.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    head = _HEAD.pack(_MAGIC, n, lanes, every, len(words))
    size = every * lanes
    points = b"".join(_POINT.pack(len(words) - d, _crc(ids[k * size:(k + 1) * size])) + st.astype("<u8").tobytes()
                      for k, (d, st) in enumerate(marks[::-1]))
    return head + points + words.astype("<u4").tobytes()


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def stretch_size(payload: bytes) -> int:
    """Ids between two checkpoints of a block (the last stretch may hold fewer)."""
    if len(payload) < _HEAD.size:
        raise ValueError("block is cut short")
    _, _, lanes, every, _ = _HEAD.unpack_from(payload)
    return lanes * every


def decode(payload: bytes, model: Model, stretch: int | None = None) -> np.ndarray:
    """All ids of a block, or those between checkpoint ``stretch`` and the next; both checked."""
    if len(payload) < _HEAD.size:
        raise ValueError("block is cut short")
    magic, n, lanes, every, n_words = _HEAD.unpack_from(payload)
    steps = -(-n // lanes) if lanes else 0
    n_points = -(-steps // every) if every else 0
    point = _POINT.size + 8 * lanes
    if magic != _MAGIC or len(payload) != _HEAD.size + n_points * point + 4 * n_words:
        raise ValueError("not a block of this format, or cut short")
    words = np.frombuffer(payload, "<u4", n_words, _HEAD.size + n_points * point).astype(np.uint64)
    out = np.empty(n, np.uint32)
    mask = np.uint64((1 << PROB_BITS) - 1)
    first, last = (0, n_points) if stretch is None else (stretch, stretch + 1)
    if not 0 <= first < max(last, 1) <= max(n_points, 1):
        raise ValueError("no such stretch")

    def mark(k: int) -> tuple[int, int, np.ndarray]:
        """Word position, CRC and lane states of a checkpoint; behind the last one, how a block ends."""
        if k >= n_points:
            return n_words, 0, np.full(lanes, _LOW, np.uint64)
        off = _HEAD.size + k * point
        return *_POINT.unpack_from(payload, off), np.frombuffer(payload, "<u8", lanes, off + _POINT.size).astype(np.uint64)

    at, state = 0, None
    for i in range(first * every, min(last * every, steps)):
        if i % every == 0:
            here, _, states = mark(i // every)
            if state is not None and (here != at or (state != states).any()):
                raise ValueError("checkpoint does not fit the words before it")
            at, state = here, states
        k = min(lanes, n - i * lanes)
        x = state[:k]
        slot = x & mask
        s = model.symbol[slot]
        out[i * lanes:i * lanes + k] = s
        x = model.freq[s] * (x >> _M) + slot - model.start[s]
        low = x < _LOW
        m = int(np.count_nonzero(low))
        if m:
            if at + m > n_words:
                raise ValueError("words are missing")
            x[low] = (x[low] << _32) | words[at:at + m]
            at += m
        state[:k] = x
    if n and (at != mark(last)[0] or (state != mark(last)[2]).any()):
        raise ValueError("words do not lead to the next checkpoint")
    size = every * lanes
    for k in range(first, last):
        if _crc(out[k * size:(k + 1) * size]) != mark(k)[1]:
            raise ValueError("checksum of the ids does not match")
    return out if stretch is None else out[first * size:min(last * size, n)]


# ---- Spark side -----------------------------------------------------------

_TOKENS = "shard int, before bigint, doc_id bigint, ids binary, counts binary"
_COUNTS = np.dtype([("symbol", "<u4"), ("n", "<i8")])
_BLOCKS = ("shard int, before bigint, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, "
           "payload binary")
_DOCS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"


def _batch(schema: str, *columns: list) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    names, types = zip(*(f.split(" ") for f in schema.split(", ")))
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=names)


def tokenized(docs: DataFrame, path: str, end_id: int, n_symbols: int, partitions: int) -> DataFrame:
    """(shard, before, doc_id, ids, counts) in ascending doc_id order.

    A shard is a range of rows and one task; ``before`` counts the shard's ids before the document. A
    shard's last row is no document: its ``ids`` are null and ``counts`` holds the shard's number of every id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, before, shard = tokens.encoder(path), np.array([end_id], "<u4").tobytes(), 0, None
        total = np.zeros(n_symbols, np.int64)
        for whole in batches:
            for b in tokens.pieces(whole):
                ids = enc.encode(b.column("text").to_pylist(), end)
                sizes = [len(x) // 4 for x in ids]
                places = [before + n for n in accumulate(sizes, initial=0)]
                before, shard = places.pop(), b.column("shard")[0].as_py()
                total += np.bincount(np.frombuffer(b"".join(ids), "<u4"), minlength=n_symbols)
                yield _batch(_TOKENS, b.column("shard").to_pylist(), places, b.column("doc_id").to_pylist(), ids,
                             [None] * len(ids))
        if shard is not None:
            yield _batch(_TOKENS, [shard], [before], [None], [None], [_packed(total)])

    order = ["doc_id", "begin", "hash", "place"]
    ranged = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")) \
        .withColumns({"begin": F.substring("text", 1, PREFIX), "hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()}) \
        .repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return ranged.select("doc_id", "text", F.spark_partition_id().alias("shard")).mapInArrow(run, _TOKENS)


def _packed(total: np.ndarray) -> bytes:
    at = np.flatnonzero(total)
    counts = np.zeros(len(at), _COUNTS)
    counts["symbol"], counts["n"] = at, total[at]
    return counts.tobytes()


def histogram(ids: DataFrame, n_symbols: int, partitions: int) -> np.ndarray:
    """The shards' ``counts`` summed as a tree: about the root of ``partitions`` tasks, then one, add them up.

    A row holds at most ``n_symbols`` entries, a task one sum of them, and one row reaches the driver.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_symbols, np.int64)
        for b in batches:
            for c in b.column("counts").to_pylist():
                held = np.frombuffer(c, _COUNTS)
                total[held["symbol"]] += held["n"]
        yield pa.record_batch({"counts": [_packed(total)]})

    rows = ids.filter("counts is not null").select("counts").coalesce(math.isqrt(partitions) + 1)
    top = rows.mapInArrow(add, "counts binary").repartition(1).mapInArrow(add, "counts binary").first()
    out, held = np.zeros(n_symbols, np.int64), np.frombuffer(top["counts"] if top else b"", _COUNTS)
    out[held["symbol"]] = held["n"]
    return out


def blocks(ids: DataFrame, freq: np.ndarray, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Rows of consecutive documents of a shard joined to blocks and coded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held, size = Model(freq), [], 0

        def block() -> pa.RecordBatch:
            whole = np.frombuffer(b"".join(x for *_, x in held), "<u4")
            return _batch(_BLOCKS, [held[0][0]], [held[0][1]], [[d for _, _, d, _ in held]],
                          [[len(x) // 4 for *_, x in held]], [len(whole)], [encode(whole, model)])

        for b in (whole.slice(a, 512) for whole in batches for a in range(0, whole.num_rows, 512)):
            for row in zip(*(b.column(c).to_pylist() for c in ("shard", "before", "doc_id", "ids"))):
                n = len(row[3]) // 4
                if held and (row[0] != held[0][0] or row[1] != held[-1][1] + len(held[-1][3]) // 4
                             or size + n > block_ids):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += n
        if held:
            yield block()

    return ids.filter("ids is not null").drop("counts").mapInArrow(run, _BLOCKS)


def write(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str, end_id: int = 0,
          partitions: int | None = None) -> None:
    """Tokenize ``docs`` and write the file set ``path``."""
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_symbols = max(tokens.n_symbols(vocabulary), end_id + 1)
    ids, scratch = written(spark, tokenized(docs, vocabulary, end_id, n_symbols, partitions), "token-ids")
    freq = scale(histogram(ids, n_symbols, partitions))
    at = np.flatnonzero(freq).tolist()
    spark.createDataFrame([(s, int(freq[s])) for s in at], "symbol bigint, freq bigint") \
        .coalesce(1).write.parquet(f"{path}/table")
    # The payloads are dense already, so the files are not compressed again.
    blocks(ids, freq).write.option("compression", "none").parquet(f"{path}/blocks")
    remove(spark, scratch)


def _opened(spark: SparkSession, path: str) -> tuple[np.ndarray, DataFrame, dict[int, int]]:
    """(frequencies, blocks, ids of all shards before each shard) of a file set."""
    # At most one row per symbol of the vocabulary, and one per shard (a range partition of the writer), reach the driver.
    held = {r["symbol"]: r["freq"]
            for r in spark.read.schema("symbol bigint, freq bigint").parquet(f"{path}/table").toLocalIterator()}
    freq = np.zeros(max(held, default=0) + 1, np.int64)
    freq[list(held)] = list(held.values())
    rows = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    sizes = rows.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    return freq, rows, dict(zip((r["shard"] for r in sizes), accumulate((r["n"] for r in sizes), initial=0)))


def read_span(spark: SparkSession, path: str, start: int, end: int) -> DataFrame:
    """The ids at ``start`` to ``end`` (exclusive, counted over all documents) as rows (start, ids binary).

    Only blocks that hold some are read, and of these only the stretches that do are decoded, one row each.
    """
    freq, rows, base = _opened(spark, path)
    at = [s for s, b in base.items() if b < end]
    if start >= end or not at:
        return rows.select(F.lit(0).cast("bigint").alias("start"), F.col("payload").alias("ids")).filter("false")
    low, high = max((s for s in at if base[s] <= start), default=at[0]), at[-1]
    rows = rows.filter(F.col("shard").between(low, high)
                       & ((F.col("shard") > low) | (F.col("before") + F.col("n_ids") > start - base[low]))
                       & ((F.col("shard") < high) | (F.col("before") < end - base[high])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(freq)
        for b in batches:
            for row in range(b.num_rows):
                shard, before, n, payload = (b.column(c)[row].as_py() for c in ("shard", "before", "n_ids", "payload"))
                at, size = base[shard] + before, stretch_size(payload)
                a, z = max(start - at, 0), min(end - at, n)
                for k in range(a // size, -(-z // size)):
                    lo, hi = max(a, k * size), min(z, (k + 1) * size)
                    ids = decode(payload, model, k)[lo - k * size:hi - k * size].astype("<u4").tobytes()
                    yield _batch("start bigint, ids binary", [at + lo], [ids])

    return rows.select("shard", "before", "n_ids", "payload").mapInArrow(run, "start bigint, ids binary")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, ids (binary, little-endian uint32)."""
    freq, rows, base = _opened(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(freq)
        for b in (whole.slice(a, 8) for whole in batches for a in range(0, whole.num_rows, 8)):
            for shard, before, doc_ids, lengths, payload in zip(*(
                    b.column(c).to_pylist() for c in ("shard", "before", "doc_ids", "lengths", "payload"))):
                ids = decode(payload, model).astype("<u4")
                ends = list(accumulate(lengths, initial=0))
                if ends[-1] != len(ids):
                    raise ValueError("lengths do not add up to the block")
                parts = [ids[a:z].tobytes() for a, z in zip(ends, ends[1:])]
                yield _batch(_DOCS, doc_ids, [base[shard] + before + a for a in ends[:-1]], lengths,
                             [zlib.crc32(x) for x in parts], parts)

    return rows.mapInArrow(run, _DOCS)


def q_token_files(spark, sf_dir):
    path = scratch_path(spark, "token-files")
    write(spark, table(spark, sf_dir, "documents"), path, tokens.vocabulary_path(), end_id=0)
    return read(spark, path).drop("ids")
