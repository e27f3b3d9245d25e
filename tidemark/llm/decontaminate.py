"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers (digits or number words), quantities (``5km``),
units that follow a number and names (one capital, inside a sentence) turn into
typed placeholders; everything else is its lower-case word without outer
punctuation. Windows of ``WINDOW`` template tokens of documents and of benchmark
items are joined by hash. Matches of a document and an item are gathered by
their shift (place in the document minus place in the item). A window counts if all its slots are equal, or
if they are consistent with most of its shift: each slot value of the item meets the value that it meets
in over half of its places there, and the other way round. So a single altered slot costs only the windows that hold it. An item is
found in a document if such windows cover ``COVERAGE`` of the item's. If all slots of the shifts are
equal the leak is ``verbatim``, else ``reparameterised``.

A window with fewer than ``LITERALS`` tokens that are no placeholder is matched with its slot values, that is, word
by word. Coverage is that of all windows or that of the templates alone, whichever is larger, so new values in
the literal-poor windows do not hide an item. An item shorter than a window is one window of its whole length.

Scale: the documents are read once. If the benchmark has at most ``PROBE_LIMIT``
different windows (8 bytes each), tasks get their hashes and pass on only document windows
that occur in the benchmark; a larger benchmark lets all windows pass to the same join.
Both ways give the same rows. A window shared by very many documents is a hot
join key, which Spark's skew handling splits; the groups after it are one document and
one item, bounded by the item's length.

Defined results: null and empty texts and items match nothing; documents with equal
doc_id and text count once; a null doc_id is reported as null; item ids with equal
texts are all reported; empty tables give no rows; extra columns are ignored (and kept by
``clean``).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from tidemark.llm.common import table, written

WINDOW = 8
LITERALS = 4
COVERAGE = 0.5
PROBE_LIMIT = 1 << 20

# Words that stand for numbers, and units.
NUMBER_WORDS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand
million billion dozen half""".split())
UNITS = frozenset("""% $ € £ mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces pound
pounds ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week
weeks month months year years cent cents dollar dollars euro euros degree degrees celsius fahrenheit kelvin percent mph
kmh volt volts watt watts joule joules newton newtons pascal hz khz mhz""".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?")
_QUANTITY = re.compile(r"[+-]?\d[\d.,]*[a-zA-Z]{1,4}")
_EDGE = "\"'()[]{}<>.,;:!?«»„“”’‘`*"
LITERAL, NUMBER, QUANTITY, UNIT, CAPITAL = 0, 1, 2, 3, 4
_H = {k: np.uint64(xxhash.xxh64_intdigest(b"\0slot%d" % k)) for k in (NUMBER, QUANTITY, UNIT, CAPITAL)}
_P = np.uint64(0x9E3779B97F4A7C15)
_VERBATIM = np.uint64(xxhash.xxh64_intdigest(b"\0verbatim"))


def _classify(word: str) -> int:
    """60 bits of the literal's hash, 3 of its kind by itself, 1 for whether a sentence ends after it."""
    bare = word.strip(_EDGE)
    low = bare.lower()
    ends = word.rstrip("\"')]»”’").endswith((".", "!", "?", ":"))
    if _NUMBER.fullmatch(bare) or low in NUMBER_WORDS:
        kind = NUMBER
    elif _QUANTITY.fullmatch(bare):
        kind = QUANTITY
    elif low in UNITS:
        kind = UNIT
    elif bare[:1].isupper() and bare[1:2].islower():     # words in capitals throughout stay literals
        kind = CAPITAL
    else:
        kind = LITERAL
    h = xxhash.xxh64_intdigest((low or word).encode("utf-8", "surrogatepass"))
    return h >> 4 << 4 | kind << 1 | ends


class Words:
    """Classified words of a worker; at most ``limit`` are kept."""

    def __init__(self, limit: int = 300_000):
        self.limit, self.known = limit, {}

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            for i, x in enumerate(found):
                if x is None:
                    w = words[i]
                    x = known.get(w)
                    if x is None:
                        x = _classify(w)
                        if len(known) < self.limit and len(w) <= 48:
                            known[w] = x
                    found[i] = x
        code = np.array(found, np.uint64)
        low = (code & np.uint64(15)).astype(np.int8)
        return code >> np.uint64(4), low >> 1, (low & 1).astype(bool)


_words = Words()


def templates(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts, their text's number, template hashes, whether each is a slot, and the words' own hashes."""
    words: list[str] = []
    owner, starts = [], []
    for k, t in enumerate(texts):
        before = len(words)
        for line in (t or "").split("\n"):
            starts.append(len(words))
            words += line.split()
        owner.append(len(words) - before)
    doc = np.repeat(np.arange(len(texts)), owner)
    h, kind, ends = _words(words)
    if not len(h):
        return words, doc, h, np.zeros(0, bool), h
    first = np.zeros(len(h) + 1, bool)
    first[starts] = True
    first[1:] |= np.append(ends, False)[:len(h)]
    first = first[:len(h)]
    after = np.zeros(len(h), bool)
    after[1:] = (kind[:-1] == NUMBER) & (doc[1:] == doc[:-1])
    slot = np.where((kind == UNIT) & ~after, LITERAL, kind)
    slot = np.where((slot == CAPITAL) & first, LITERAL, slot)
    own = h
    for k, v in _H.items():
        h = np.where(slot == k, v, h)
    return words, doc, h, slot != LITERAL, own


def _fold(value: np.ndarray, h: np.ndarray, at: np.ndarray | slice, size: int) -> np.ndarray:
    for i in range(size):
        value = value * _P + (h[at.start + i:at.stop + i] if isinstance(at, slice) else h[at + i])
        value ^= value >> np.uint64(29)
    return value


def windows(doc: np.ndarray, h: np.ndarray, slot: np.ndarray, own: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, hashes, whether templates) of the windows of ``size`` tokens inside one text.

    Windows with enough literals are templates; of the others the words themselves are hashed.
    """
    n = len(h) - size + 1
    if n <= 0 or size <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
    literals = np.concatenate([[0], np.cumsum(~slot)])
    inside = doc[:n] == doc[size - 1:]
    rich = literals[size:] - literals[:n] >= LITERALS
    poor = np.flatnonzero(inside & ~rich)
    if size >= LITERALS:
        value = _fold(np.full(n, np.uint64(size)), h, slice(0, n), size)
    else:
        value = np.zeros(n, np.uint64)
    value[poor] = _fold(np.full(len(poor), np.uint64(size) ^ _VERBATIM), own, poor, size)
    at = np.flatnonzero(inside)
    return at, value[at], rich[at]


_ITEM = "item_id bigint, ipos bigint, hash bigint, islots array<string>, places array<int>, size int, rich int, n_rich bigint, n_all bigint"
_DOC = "doc_id bigint, text_key string, dpos bigint, hash bigint, dslots array<string>, size int"


def _slots(words: list[str], slot: np.ndarray, at: int, size: int) -> list[str]:
    return [words[at + i].strip(_EDGE).lower() for i in np.flatnonzero(slot[at:at + size])]


def item_windows(benchmark: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                words, doc, h, slot, own = templates([text])
                size = min(WINDOW, len(words))
                at, value, rich = windows(doc, h, slot, own, size)
                rows += [(item, a, v, _slots(words, slot, a, size), (np.flatnonzero(slot[a:a + size]) + a).tolist(), size, r, int(rich.sum()), len(at))
                         for a, v, r in zip(at.tolist(), value.view(np.int64).tolist(), rich.astype(int).tolist())]
            yield _batch(_ITEM, rows)

    return benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").mapInArrow(run, _ITEM)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "array<string>": pa.list_(pa.string()),
             "array<int>": pa.list_(pa.int32())}
    names, types = zip(*(f.split(" ") for f in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.record_batch([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=names)


def doc_windows(docs: DataFrame, sizes: list[int], probe: np.ndarray | None) -> DataFrame:
    """Windows of the documents; with ``probe`` (sorted hashes) only those whose hash is in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if probe is not None:
            seen = np.zeros(1 << 20, bool)
            seen[probe >> np.uint64(44)] = True
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                b = whole.slice(a, 256)
                ids, keys = b.column("doc_id").to_pylist(), b.column("text_key").to_pylist()
                words, doc, h, slot, own = templates(b.column("text").to_pylist())
                begin = np.searchsorted(doc, np.arange(b.num_rows))
                rows = []
                for size in sizes:
                    at, value, _ = windows(doc, h, slot, own, size)
                    if probe is not None and len(at):
                        maybe = np.flatnonzero(seen[value >> np.uint64(44)])
                        near = np.minimum(np.searchsorted(probe, value[maybe]), len(probe) - 1)
                        maybe = maybe[probe[near] == value[maybe]]
                        at, value = at[maybe], value[maybe]
                    rows += [(ids[d], keys[d], int(p - begin[d]), int(v), _slots(words, slot, p, size), size)
                             for p, d, v in zip(at.tolist(), doc[at].tolist(), value.view(np.int64))]
                yield _batch(_DOC, rows)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(F.col("text").cast("binary")).alias("text_key"),
                       "text").filter(F.col("text").isNotNull())
    return rows.mapInArrow(run, _DOC)


def consistent(windows_: list[tuple[list[str], list[str], list[int]]]) -> list[bool]:
    """Which windows (slots of the item, slots of the document, their places) of one shift count.

    Those with equal slots, and those whose every pair of values is in over half the places of either value.
    """
    pairs = {p for w in windows_ for p in zip(*w)}
    of_item, of_doc = Counter(i for i, _, _ in pairs), Counter(d for _, d, _ in pairs)
    both = Counter((i, d) for i, d, _ in pairs)
    most = {(i, d) for (i, d), k in both.items() if 2 * k > of_item[i] and 2 * k > of_doc[d]}
    return [i == d or most.issuperset(zip(i, d)) for i, d, _ in windows_]


@F.arrow_udf(ArrayType(BooleanType()))
def _counts(w: pa.Array) -> pa.Array:
    return pa.array([consistent([(x["islots"], x["dslots"], x["places"]) for x in ws]) for ws in w.to_pylist()], pa.list_(pa.bool_()))


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, text_key, item_id, n_windows, coverage, kind: the items found in the documents."""
    items, _ = written(spark, item_windows(benchmark), "item-windows")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())         # at most WINDOW sizes
    hashes = items.select("hash").distinct()
    probe = None
    if hashes.count() <= PROBE_LIMIT:
        probe = np.sort(np.array([r["hash"] for r in hashes.toLocalIterator()], np.int64).view(np.uint64))
    found = doc_windows(docs, sizes, probe).join(items, ["hash", "size"])
    window = F.struct("ipos", "rich", "islots", "dslots", "places").alias("w")
    shift = found.select("doc_id", "text_key", "item_id", "n_rich", "n_all", (F.col("dpos") - F.col("ipos")).alias("shift"), window) \
        .groupBy("doc_id", "text_key", "item_id", "shift").agg(
            F.max("n_rich").alias("n_rich"), F.max("n_all").alias("n_all"), F.collect_set("w").alias("w")) \
        .withColumn("verbatim", F.forall("w", lambda w: w["islots"] == w["dslots"]))
    counted = shift.withColumn("ok", _counts("w")).withColumn("w", F.explode(F.filter(F.arrays_zip("w", "ok"), lambda x: x["ok"]))) \
        .select("doc_id", "text_key", "item_id", "n_rich", "n_all", "verbatim", "w.w.ipos", "w.w.rich")
    n, rich = F.count(F.lit(1)), F.sum("rich")
    over_all = n / F.max("n_all")
    over_rich = F.when(F.max("n_rich") > 0, rich / F.max("n_rich")).otherwise(F.lit(0.0))
    return counted.groupBy("doc_id", "text_key", "item_id", "ipos").agg(
            F.max("n_rich").alias("n_rich"), F.max("n_all").alias("n_all"), F.max("rich").alias("rich"),
            F.max("verbatim").alias("verbatim")) \
        .groupBy("doc_id", "text_key", "item_id").agg(
            F.when(over_rich >= over_all, rich).otherwise(n).alias("n_windows"),
            F.greatest(over_rich, over_all).alias("coverage"),
            F.when(F.min("verbatim"), "verbatim").otherwise("reparameterised").alias("kind")) \
        .filter(F.col("coverage") >= coverage)


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The documents in which no item was found, in their own columns.

    A leak is a fact about a text, so rows are dropped by the text's digest and
    documents without an id are told apart.
    """
    bad = leaks(spark, docs, benchmark, coverage).select(F.col("text_key").alias("leaked")).distinct()
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    return docs.select(own, F.md5(F.col("text").cast("binary")).alias("k")) \
        .join(bad, F.col("k") == F.col("leaked"), "left_anti").select("d.*")


def q_decontaminate(spark, sf_dir):
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .select("doc_id", "item_id", "n_windows", "coverage", "kind")
