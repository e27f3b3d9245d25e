"""Importance resampling towards a target distribution.

Features are single words and pairs of neighbouring words, hashed to buckets. The gain of a bucket
is the scaled log ratio of its (smoothed) share in the target texts to that in the corpus; a
document's weight is the floored mean of its features' gains, and its score adds Gumbel noise
from a hash of its id, so taking the highest scores samples without replacement in
proportion to the weights. Gains are one array; a document's are summed by one look-up in it.

The cutoff of the draw is found by bisection on numbers: exact counting jobs over the written scores, each
halving the interval (``CUTS`` + 1 parts a job), first on the score, then, among the rows of the cutoff
score, on doc_id. Nothing is sorted for it. The rows above the cutoff are range-partitioned by
(score, doc_id) and numbered by their partition's offset, so no task sees more than its range.

Scale: two passes over the texts, no shuffle of texts. The driver gets ``BUCKETS`` counts per table, one
row of counts per job and one count per range. Words are taken from a text piece by piece, so memory
is bounded for any text.

Defined results: a null text has no words; a document without features has weight 0; a null
doc_id is hashed as empty text and comes after all others of its score; repeated rows are scored and
drawn one by one (rows equal in score and doc_id are ranked in any order, as many as the draw needs); an
empty target or corpus leaves the smoothed shares; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

BUCKETS = 10_000
CUTS = 15                       # counts of one job: four halvings of the interval
PIECE = 1 << 20
# Words are runs of ASCII letters, digits and anything beyond ASCII; A-Z are lowered. UTF-8 bytes beyond
# ASCII are never separators, so this works on bytes.
_WORDS = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
_WORD_END = re.compile(rb" ")


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size; each list after the first starts with the last word before it."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)
    at, last = 0, []
    while at < len(data):
        end = len(data)
        if end - at > PIECE:
            cut = _WORD_END.search(data, at + PIECE)
            end = cut.start() if cut else end
        words = last + data[at:end].split()
        if len(words) > len(last):
            yield words
            last = words[-1:]
        at = end


def buckets(text: str | None) -> Iterator[tuple[int, np.ndarray]]:
    """Per piece: new words, and the buckets of their features."""
    first = True
    for words in pieces(text):
        new = words if first else words[1:]
        pairs = [a + b" " + b for a, b in zip(words, words[1:])]
        h = np.fromiter(map(crc32, new), np.uint32, len(new)), np.fromiter(map(crc32, pairs), np.uint32, len(pairs))
        yield len(new), (np.concatenate(h) % np.uint32(BUCKETS)).astype(np.int64)
        first = False


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in the column ``text`` of all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for t in b.column("text"):
                for _, h in buckets(t.as_py()):
                    n += np.bincount(h, minlength=BUCKETS)
        at = np.flatnonzero(n)
        yield pa.record_batch({"bucket": at, "n": n[at]})

    out = np.zeros(BUCKETS, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]                       # BUCKETS rows at most
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.zeros((3, b.num_rows), np.int64)
            for i, t in enumerate(b.column("text")):
                total = 0
                for n, h in buckets(t.as_py()):
                    rows[0, i] += n
                    rows[1, i] += len(h)
                    total += int(gain[h].sum())
                if rows[1, i]:
                    rows[2, i] = total // int(rows[1, i])
            yield pa.record_batch([b.column("doc_id"), *map(pa.array, rows)], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def scored(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with ``score``: the weight plus Gumbel noise from the document's id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296)))
    return rows.withColumn("score", F.col("weight") + noise)


def _smallest(rows: DataFrame, value: str, want: int) -> int | None:
    """The smallest v for which ``want`` rows have a value of at most v (None: there are not that many).

    Each job counts the rows up to ``CUTS`` values that part the interval evenly.
    """
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(value)).first()
    if n < want:
        return None
    while low < high:
        cuts = sorted({low + (high - low) * (i + 1) // (CUTS + 1) for i in range(CUTS)})
        got = rows.agg(*[F.count_if(F.col(value) <= c) for c in cuts]).first()
        at = next((i for i, x in enumerate(got) if x >= want), None)
        if at is None:
            low = cuts[-1] + 1
        else:
            low, high = cuts[at - 1] + 1 if at else low, cuts[at]
    return low


def cutoff(rows: DataFrame, want: int) -> Column:
    """Whether a row is among the ``want`` highest scores of ``rows``, ties to the smaller doc_id.

    If rows equal in both lie at the cutoff, it holds for all of them; the ranks decide.
    """
    if want <= 0:
        return F.lit(False)
    down = rows.select("doc_id", F.negative("score").alias("down"))
    at = _smallest(down, "down", want)
    if at is None:
        return F.lit(True)
    above = down.filter(F.col("down") < at).count()
    last = _smallest(down.filter((F.col("down") == at) & F.col("doc_id").isNotNull()), "doc_id", want - above)
    tied = F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= last, F.lit(False))
    return (F.col("score") > -at) | ((F.col("score") == -at) & tied)


def ranked(spark: SparkSession, rows: DataFrame, n_rows: int, per_range: int = 1 << 20) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... by descending score, then doc_id."""
    parts = max(1, -(-n_rows // per_range), min(spark.sparkContext.defaultParallelism, n_rows // 10_000))
    # The place in the input splits a range of equal rows.
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("_place")]
    dealt = rows.withColumn("_place", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(parts, *order) \
        .sortWithinPartitions(*order).drop("_place").withColumn("_at", F.monotonically_increasing_id())
    dealt, _ = written(spark, dealt, "drawn")
    part = F.shiftright("_at", 33)                 # partition number in the upper bits, place in the lower 33
    sizes = {r["p"]: r["n"] for r in dealt.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, seen = {}, 0
    for p in sorted(sizes):                        # one number per range
        offsets[p], seen = seen, seen + sizes[p]
    offset = F.broadcast(spark.createDataFrame(list(offsets.items()), "_part long, _before long"))
    return dealt.withColumn("_part", part).join(offset, "_part") \
        .withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20,
             seed: int = 7) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (undrawn: rank null).

    ``percent`` of the documents with at least ``min_words`` words are drawn; ``target`` has a column ``text``.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows, _ = written(spark, scored(weighted(docs, gain), seed), "scored")
    long = F.col("n_words") >= min_words
    eligible = rows.filter(long)
    want = percent * eligible.count() // 100
    taken = long & cutoff(eligible, want)
    columns = ["doc_id", "n_features", "weight", "score"]
    top = ranked(spark, rows.filter(taken).select(*columns), want) \
        .withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")))
    return top.unionByName(rows.filter(~taken).select(*columns, F.lit(None).cast("bigint").alias("rank")))


def q_resample(spark, sf_dir):
    return resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
