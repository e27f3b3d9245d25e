"""Packing documents into fixed windows with non-negative least squares.

A document's ids are cut into whole windows and one tail. Tails are put into
length bins, and a *pattern* is a shallow combination of bins (at most
``PARTS`` tails) that fills a window exactly. Lawson-Hanson non-negative least
squares gives each pattern the repeat count whose mixture comes closest to the
histogram of tails; the counts are rounded down and realised. What is left is
packed greedily (largest first, then the largest that still fits). The small
gaps of both are then closed by cutting up the emptiest windows, so at most one
window of a group stays partly empty.

Scale: a document meets only the documents of its group. Groups are dealt by a
hash of the row, so no key can be hot, and their number follows from the number
of documents and characters, which bounds what one task holds. A document's ids
are shuffled once; there is no global rank, join or sort, and the driver sees two
numbers. With thousands of documents in a group the histogram of a group is that
of the table. Rows are numbered as they are scanned, so pass a table read from files: a
task that is run again then sees the same rows.

Defined results: a null or empty text is a document of only the end id; repeated
rows are packed one by one; a null doc_id is kept as such; a text longer than a
window gives whole windows and a tail; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import tokens
from tidemark.llm.common import table

WINDOW = 2048
BINS = 64
PARTS = 4
GROUP_DOCS = 8192
GROUP_CHARS = 8_000_000
_OUT = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint")

# A piece is (document index, start, length); a window is a list of pieces.
Piece = tuple[int, int, int]


@cache
def patterns(bins: int = BINS, parts: int = PARTS) -> np.ndarray:
    """Every multiset of at most ``parts`` bins that fills a window, as rows of bin counts."""
    found: list[list[int]] = []

    def extend(left: int, least: int, chosen: list[int]) -> None:
        if left == 0:
            found.append(chosen)
        elif len(chosen) < parts:
            for b in range(least, left + 1):
                if b == left or left - b >= b:
                    extend(left - b, b, [*chosen, b])

    extend(bins, 1, [])
    rows = np.zeros((len(found), bins))
    for i, p in enumerate(found):
        for b in p:
            rows[i, b - 1] += 1
    return rows


def nnls(a: np.ndarray, b: np.ndarray, tolerance: float = 1e-9) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by Lawson and Hanson's active sets."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    scale = max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[0] + 10):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= tolerance * scale:
            break
        active[j] = True
        while True:
            idx = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, idx], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[idx] = z
                break
            old = x[idx]
            low = z <= 0
            step = (old[low] / np.maximum(old[low] - z[low], 1e-300)).min()
            new = old + step * (z - old)
            new[low & (new <= tolerance * scale)] = 0
            gone = idx[new <= 0]
            if not len(gone):
                gone = idx[[int(np.argmin(new))]]
            x[idx] = np.maximum(new, 0)
            x[gone] = 0
            active[gone] = False
            if not active.any():
                break
    return x


def pack(sizes: list[int], window: int = WINDOW, bins: int = BINS) -> list[list[Piece]]:
    """Windows of pieces that hold every token of documents of these sizes once."""
    windows: list[list[Piece]] = []
    width = -(-window // bins)
    tails: dict[int, list[Piece]] = defaultdict(list)
    for d, n in enumerate(sizes):
        whole = n // window
        windows += [[(d, k * window, window)] for k in range(whole)]
        if n % window:
            tails[-(-(n % window) // width)].append((d, whole * window, n % window))
    for t in tails.values():
        t.sort(key=lambda p: (p[2], p[0]))              # the longest of a bin is taken first
    made: list[list[Piece]] = []
    if tails:
        shapes = patterns(bins)
        counts = np.array([len(tails.get(b + 1, ())) for b in range(bins)], float)
        usable = np.flatnonzero(((shapes > 0) & (counts == 0)).sum(axis=1) == 0)
        if len(usable):
            repeats = np.floor(nnls(shapes[usable].T, counts) + 1e-6).astype(int)
            for p, r in zip(usable, repeats):
                need = [(b + 1, int(k)) for b, k in enumerate(shapes[p]) if k]
                r = min([r, *(len(tails[b]) // k for b, k in need)])
                made += [[tails[b].pop() for b, k in need for _ in range(k)] for _ in range(r)]
    made += _greedy([p for t in tails.values() for p in t], window)
    return windows + _close(made, window)


def _greedy(pieces: list[Piece], window: int) -> list[list[Piece]]:
    """Largest piece first, then the largest that still fits."""
    by: dict[int, list[Piece]] = defaultdict(list)
    for p in sorted(pieces, key=lambda p: (p[2], p[0])):
        by[p[2]].append(p)
    lengths = sorted(by)
    out = []
    while lengths:
        left, made = window, []
        while lengths and (i := bisect.bisect_right(lengths, left)):
            n = lengths[i - 1]
            made.append(by[n].pop())
            left -= n
            if not by[n]:
                lengths.pop(i - 1)
        out.append(made)
    return out


def _close(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """Fill gaps with pieces cut from the emptiest windows."""
    used = lambda w: sum(p[2] for p in w)
    windows = sorted(windows, key=used, reverse=True)
    pool: list[Piece] = []
    done, i = [], 0
    while i < len(windows):
        w = windows[i]
        i += 1
        gap = window - used(w)
        while gap:
            if not pool:
                if i >= len(windows):
                    break
                pool = windows.pop()
            d, start, n = pool.pop()
            take = min(n, gap)
            w = [*w, (d, start, take)]
            gap -= take
            if take < n:
                pool.append((d, start + take, n - take))
        done.append(w)
    if pool:
        done.append(pool)
    return done


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = WINDOW,
                   group_docs: int = GROUP_DOCS, group_chars: int = GROUP_CHARS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n, chars = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()
    groups = max(1, -(-n // group_docs), -(-chars // group_chars))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = tokens.encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for b in tokens.pieces(whole):
                ids = enc.encode(b.column("text").to_pylist(), end)
                yield pa.record_batch([b.column("g"), b.column("row"), b.column("doc_id"), pa.array(ids, pa.binary())],
                                      names=["g", "row", "doc_id", "ids"])

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by("row").combine_chunks()
        ids, doc_id = group.column("ids"), group.column("doc_id").to_pylist()
        ids = [x.as_buffer() for x in ids]
        base = group.column("g")[0].as_py() << 32
        out: list[tuple] = []
        for k, w in enumerate(pack([x.size // 4 for x in ids], window)):
            at = 0
            for d, start, length in w:
                out.append((doc_id[d], start, length, zlib.crc32(ids[d].slice(4 * start, 4 * length)),
                            ids[d].size // 4, base + k, at))
                at += length
        names = [f.split(" ")[0] for f in _OUT.split(", ")]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    rows = docs.withColumn("row", F.monotonically_increasing_id()) \
        .withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    return rows.select("g", "row", "doc_id", "text") \
        .mapInArrow(encoded, "g bigint, row bigint, doc_id bigint, ids binary") \
        .groupBy("g").applyInArrow(packed, _OUT)


def q_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), tokens.vocabulary_path(), end_id=1)
