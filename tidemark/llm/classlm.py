"""Language-model scoring with Brown word classes.

The probability of a token is that of its class after the class before, times that of the word
within its class. Exchange clustering finds the classes of the ``CLUSTERED`` most
frequent words: round by round, a quarter of the words ask which of the ``CLASSES`` classes would raise the
likelihood of the class bigrams most, given everybody's class, and move there; the best of the rounds'
clusterings is taken. The round is a job over the words' neighbour counts, so no task or driver holds more than
its words and one class matrix. Meanwhile all other words are in ``SHAPES`` classes by
what they are made of, and the end of a text is a class of its own. Then every other word of the training texts,
however many there are, asks the same (``train_whole``): its counts beside each class are grouped by word, and it moves to
the class that raises the likelihood most, or stays with its shape if none does. Transitions are interpolated with
the classes' own shares, words of a shape class get ``EXTRA`` counts each and once more for all unknown ones.
``train`` and ``score`` are the smaller model, whose other words keep their shapes.

Counts cover all training texts: a table of every different word grows with the corpus. Each
task holds the counts of the words that are more frequent than the ``LOOKUP``-th (found by counting jobs);
any other word is at most a 1/``LOOKUP`` share of the tokens, so the join of documents' other
words with the table of counts has no hot key in training, and a word frequent in held-out texts alone is
split by Spark's skew join. Neighbour counts are a table bounded by the square of ``CLUSTERED`` + ``SHAPES`` + 1.

Texts are split and their words numbered a column at a time, about ``BLOCK`` bytes or one text. A rare word leaves a batch
as one row with its counts beside each class, and its rows are summed one after the other (``contexts``, ``choose_classes``).

The driver gets at most ``LOOKUP`` words with their classes and a matrix per task and round. Texts are
never shuffled; two passes read them (words, places). The second leaves a number per token and the words of each document
that are not looked up; these meet their classes and counts by a join and return to their document,
whose tokens are then a byte each, the class.

Defined results: a null text is empty and has one token, the end; a null doc_id is never learned
from and not held out; repeated rows are counted and scored each; words longer than 32 bytes are known by
a 128-bit hash; without training texts every token has base probability 1 and the model spreads evenly
over classes; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remove, table, written
from tidemark.llm.resample import _smallest

FOLDS, HELD_OUT = 10, 0
CLUSTERED, CLASSES, SHAPES = 4_096, 64, 32
ROUNDS, MOVERS = 12, 0.25           # rounds of exchange, share of the words asked in each
LOOKUP = 1 << 17
EXTRA, MIX = 0.1, 1.0
SHARDS = 32
FLUSH, PIECE = 1 << 20, 1 << 20
BLOCK = 1 << 25                      # bytes of text split at a time, unless one text has more
CACHE = 300_000                      # words a task remembers, the looked-up ones included
END = b"\xfe"                        # not UTF-8, so never a word
# A-Z to lower case, the other white space to blanks.
_LOWER = bytes(i + 32 if 65 <= i <= 90 else 32 if 9 <= i <= 13 else i for i in range(256))
_DIGITS, _BLANK = b"0123456789", re.compile(rb" ")
_MARKS = bytes(i for i in range(33, 127) if not chr(i).isalnum())


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def word_lists(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of bounded size."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > PIECE:
            cut = _BLANK.search(data, at + PIECE)
            end = cut.start() if cut else end
        yield data[at:end].split()
        at = end


def key(word: bytes) -> bytes:
    return word if len(word) <= 32 else b"\xff" + xxhash.xxh3_128_digest(word)


def shape(word: bytes) -> int:
    """0 to SHAPES - 1: length in four steps, other scripts, digits, marks."""
    n = len(word)
    size = 0 if n <= 4 else 1 if n <= 7 else 2 if n <= 11 else 3
    if word.isalpha():
        return size
    return size + 4 * ((not word.isascii()) + 2 * (len(word.translate(None, _DIGITS)) < n)
                       + 4 * (len(word.translate(None, _MARKS)) < n))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``word_lists`` of a column: the words of all texts in order, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words, sizes = lists.flatten().cast(pa.binary()), lists.value_lengths().to_numpy().astype(np.int64)
    full = pc.binary_length(words).to_numpy() > 0                       # white space at the edges leaves empty ones
    if full.all():
        return words, sizes
    ends = np.cumsum(sizes)
    before = np.concatenate([[0], np.cumsum(full)])
    return words.filter(pa.array(full)), before[ends] - before[ends - sizes]


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """A column in slices of at most BLOCK bytes, or of one text."""
    total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(total, BLOCK + (total[at - 1] if at else 0), "right")))
        yield texts.slice(at, end - at)
        at = end


def keys(words: pa.Array) -> pa.Array:
    """``key`` of every word."""
    long = pc.greater(pc.binary_length(words), 32)
    return pc.replace_with_mask(words, long, pa.array(map(key, words.filter(long).to_pylist()), pa.binary()))


# what a byte is: 1 not ASCII, 2 a digit, 4 a mark
_KINDS = np.array([(i > 127) + 2 * (i in _DIGITS) + 4 * (i in _MARKS) for i in range(256)], np.uint8)


def shapes_of(words: pa.Array) -> np.ndarray:
    """``shape`` of every word."""
    n = pc.binary_length(words).to_numpy().astype(np.int64)
    kinds = _KINDS[np.frombuffer(b"".join(words.to_pylist()), np.uint8)]
    kinds = np.bitwise_or.reduceat(kinds, np.cumsum(n) - n) if len(n) else kinds
    return np.searchsorted([4, 7, 11], n) + 4 * kinds.astype(np.int64)


def binary_rows(values: np.ndarray, stops: np.ndarray) -> pa.Array:
    """The bytes of values as one binary per row; a row ends before its stop."""
    offsets = np.concatenate([[0], stops]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), len(stops), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])


class Places(dict):
    """Word -> its place among the looked-up words; any other word -> their number + its shape."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.n = len(words)

    def __missing__(self, word: bytes) -> int:
        k = key(word)
        at = self[k] if len(word) > 32 and k in self else self.n + shape(word)
        if len(self) < max(CACHE, self.n) and len(word) <= 32:
            self[word] = at
        return at


def count_words(texts: DataFrame) -> DataFrame:
    """(word, shape, n) of every different word, and of the end of texts, whose shape is SHAPES."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            seen = pa.chunked_array(held, pa.binary()).value_counts()
            words = seen.field("values")
            return pa.record_batch({"word": keys(words), "shape": pa.array(shapes_of(words), pa.int32()), "n": seen.field("counts")})
        held, size, ends = [], 0, 0
        for b in batches:
            ends += b.num_rows
            for some in blocks(b.column("text")):
                held.append(split_words(some)[0])
                size += held[-1].nbytes
                if size >= BLOCK:
                    yield rows()
                    held, size = [], 0
        yield rows()
        if ends:
            yield pa.record_batch({"word": pa.array([END], pa.binary()), "shape": pa.array([SHAPES], pa.int32()), "n": pa.array([ends])})

    return texts.select("text").mapInArrow(run, "word binary, shape int, n bigint") \
        .groupBy("word", "shape").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """The counts of training texts: the looked-up words, most frequent first, and totals of all."""

    words: list[bytes]
    shapes: np.ndarray
    n: np.ndarray
    ends: int
    tokens: int                           # N, ends included
    distinct: int                         # V, the end included
    by_shape: np.ndarray                  # different words per shape

    def clustered(self) -> int:
        return min(CLUSTERED, len(self.words))

    def units(self) -> np.ndarray:
        """Per place: 0 to CLUSTERED - 1 for a clustered word, then one unit per shape, then the end."""
        own = CLUSTERED + self.shapes
        own[:self.clustered()] = np.arange(self.clustered())
        return np.concatenate([own, CLUSTERED + np.arange(SHAPES + 1)])


def look_up(counts: DataFrame) -> Words:
    """Fewer than LOOKUP words: those more frequent than the LOOKUP-th, found by counting."""
    own = counts.filter(F.col("shape") < SHAPES)
    by_shape, tokens = np.zeros(SHAPES + 1, np.int64), 0
    ends = 0
    for r in counts.groupBy("shape").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect():   # SHAPES + 1 rows
        by_shape[r["shape"]], tokens = r["v"], tokens + r["n"]
        ends += r["n"] if r["shape"] == SHAPES else 0
    least = _smallest(own.select(F.negative("n").alias("down")), "down", LOOKUP)
    rows = own.filter(F.lit(True) if least is None else F.col("n") > -least).toArrow()
    words, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-n[i], words[i]))
    return Words([words[i] for i in order], rows.column("shape").to_numpy()[order].astype(np.int64), n[order], ends, tokens,
                 int(by_shape.sum()), by_shape[:SHAPES])


def count_neighbours(texts: DataFrame, words: Words) -> DataFrame:
    """(code, n): how often unit code % U follows unit code / U, over all tokens."""
    units, size = words.units(), CLUSTERED + SHAPES + 1
    vocabulary, end = words.words, len(words.words) + SHAPES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(vocabulary)

        def rows() -> pa.RecordBatch:
            seq = units[np.concatenate(held)]
            code, n = np.unique(seq[:-1] * size + seq[1:], return_counts=True)
            return pa.record_batch({"code": code, "n": n})
        # one sequence: an end before the first text and after each
        held, n = [np.array([end])], 0
        for b in batches:
            for t in b.column("text"):
                for some in word_lists(t.as_py()):
                    held.append(np.fromiter(map(places.__getitem__, some), np.int64, len(some)))
                    n += len(some)
                    if n >= 4 * FLUSH:
                        yield rows()
                        held, n = [held[-1][-1:]] if len(some) else held, 0
                held.append(np.array([end]))
        yield rows()

    return texts.select("text").mapInArrow(run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def profiles(neighbours: DataFrame) -> DataFrame:
    """One row per unit: its neighbours (other, + U for those that follow) and their counts, as arrays in bytes."""
    size = CLUSTERED + SHAPES + 1
    a, b = F.floor(F.col("code") / size).cast("int"), (F.col("code") % size).cast("int")
    both = neighbours.select(F.explode(F.array(F.struct(a.alias("unit"), (b + size).alias("other")),
                                               F.struct(b.alias("unit"), a.alias("other")))).alias("x"), "n") \
        .select("x.unit", "x.other", "n", F.pmod("x.unit", F.lit(SHARDS)).alias("shard"))

    def run(rows: pa.Table) -> pa.Table:
        unit, other, n = (rows.column(c).to_numpy() for c in ("unit", "other", "n"))
        order = np.lexsort((other, unit))
        unit, other, n = unit[order], other[order].astype("<i4"), n[order].astype("<i8")
        own, start = np.unique(unit, return_index=True)
        stop = np.append(start[1:], len(unit))
        return pa.table({"unit": own.astype(np.int32), "others": pa.array([other[i:j].tobytes() for i, j in zip(start, stop)], pa.binary()),
                         "n": pa.array([n[i:j].tobytes() for i, j in zip(start, stop)], pa.binary())})

    # a group has at most 2 U * U / SHARDS rows
    return both.repartition(SHARDS, "shard").groupBy("shard").applyInArrow(run, "unit int, others binary, n binary")


def _unit_rows(batch: pa.RecordBatch, of: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """unit, tokens of each class after it and before it, and after itself."""
    size = CLUSTERED + SHAPES + 1
    for u, others, n in zip(batch.column("unit").to_pylist(), batch.column("others").to_pylist(), batch.column("n").to_pylist()):
        others, n = np.frombuffer(others, "<i4"), np.frombuffer(n, "<i8")
        after = others >= size
        yield (u, np.bincount(of[others[after] - size], n[after], CLASSES + SHAPES + 1),
               np.bincount(of[others[~after]], n[~after], CLASSES + SHAPES + 1), int(n[others == u + size].sum()))


def class_matrix(rows: DataFrame, of: np.ndarray) -> np.ndarray:
    """Counts of class after class, given the class of every unit."""
    c = CLASSES + SHAPES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((c, c), "<i8")
        for b in batches:
            for u, after, _, _ in _unit_rows(b, of):
                m[of[u]] += after.astype(np.int64)
        yield pa.record_batch({"m": pa.array([m.tobytes()], pa.binary())})

    parts = rows.mapInArrow(run, "m binary").collect()             # a matrix per task of a table with U rows
    return sum((np.frombuffer(r["m"], "<i8").reshape(c, c) for r in parts), np.zeros((c, c), np.int64))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(m: np.ndarray) -> float:
    """The log-likelihood of the class bigrams, but for the words' own term, which no exchange changes."""
    return float(xlogx(m).sum() - xlogx(m.sum(0)).sum() - xlogx(m.sum(1)).sum())


def best_class(m: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, same: int) -> tuple[int, float]:
    """The class that gives the likelihood most if the unit moves there, and the gain over staying."""
    m, out, into = m.astype(np.float64), m.sum(1).astype(np.float64), m.sum(0).astype(np.float64)
    n_out, n_in = after.sum(), before.sum()
    after, before = after.copy(), before.copy()
    after[own] -= same
    before[own] -= same
    m[own] -= after
    m[:, own] -= before
    m[own, own] -= same
    out[own] -= n_out
    into[own] -= n_in
    k = np.arange(CLASSES)
    rows, cols, diagonal = m[:CLASSES], m[:, :CLASSES].T, m[k, k]
    gain = (xlogx(rows + after) - xlogx(rows)).sum(1) + (xlogx(cols + before) - xlogx(cols)).sum(1)
    # the cell of the class with itself gets both, once
    gain += xlogx(diagonal + after[k] + before[k] + same) + xlogx(diagonal) - xlogx(diagonal + after[k]) - xlogx(diagonal + before[k])
    gain -= xlogx(out[k] + n_out) - xlogx(out[k]) + xlogx(into[k] + n_in) - xlogx(into[k])
    to = int(np.argmax(gain))
    return to, float(gain[to] - gain[own])


def exchange(rows: DataFrame, n_clustered: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Class per unit, class matrix, and the likelihood of every round's clustering.

    A round that lowers the likelihood is taken back, and half as many words move from then on.
    """
    of = np.concatenate([np.arange(CLUSTERED) % CLASSES, CLASSES + np.arange(SHAPES + 1)])
    best, seen, share = None, [], MOVERS
    for t in range(rounds + 1):
        m = class_matrix(rows, of)
        seen.append(likelihood(m))
        if best is None or seen[-1] > best[0]:
            best = (seen[-1], of, m)
        else:
            _, of, m = best
            share /= 2
        if t == rounds:
            break
        asked = np.flatnonzero(np.random.default_rng(t).random(CLUSTERED)[:n_clustered] < share)

        def run(batches: Iterator[pa.RecordBatch], m=m, of=of, asked=frozenset(asked.tolist())) -> Iterator[pa.RecordBatch]:
            for b in batches:
                b = b.filter(pa.array([u in asked for u in b.column("unit").to_pylist()], pa.bool_()))
                moves = [(u, *best_class(m, of[u], after, before, same)) for u, after, before, same in _unit_rows(b, of)]
                moves = [(u, to) for u, to, gain in moves if gain > 1e-6]
                yield pa.record_batch([pa.array([x[0] for x in moves], pa.int32()), pa.array([x[1] for x in moves], pa.int32())],
                                      names=["unit", "class"])

        moved = rows.mapInArrow(run, "unit int, class int").collect()          # at most CLUSTERED rows
        of = of.copy()
        for r in moved:
            of[r["unit"]] = r["class"]
    return best[1], best[2], seen


@dataclass
class Model:
    """A trained model: what every task holds, and the path of the counts of all words, if scoring reads them."""

    words: Words
    of: np.ndarray                        # class per unit
    matrix: np.ndarray                    # class after class
    likelihoods: list[float]
    counts: str

    def transitions(self) -> np.ndarray:
        """log10 P(class | class before)."""
        own = self.matrix.sum(0) + EXTRA
        share = own / own.sum()
        return np.log10((self.matrix + MIX * share) / (self.matrix.sum(1, keepdims=True) + MIX))

    def tokens_of_class(self) -> np.ndarray:
        return self.matrix.sum(0)

    def unclustered(self) -> np.ndarray:
        """Different words per shape that have no class of their own."""
        w = self.words
        return w.by_shape - np.bincount(w.shapes[:w.clustered()], minlength=SHAPES)

    def shape_total(self) -> np.ndarray:
        """Per shape the sum of the counts with their extras, one unknown word included."""
        return self.tokens_of_class()[CLASSES:CLASSES + SHAPES] + EXTRA * (self.unclustered() + 1)

    def base_total(self) -> float:
        return self.words.tokens + EXTRA * (self.words.distinct + 1)

    def emissions(self) -> np.ndarray:
        """Per place: log10 P(word | class); 0 for the shapes, whose words are scored one by one, and the end."""
        w, m = self.words, self.words.clustered()
        out = np.zeros(len(w.words) + SHAPES + 1)
        out[m:len(w.words)] = np.log10((w.n[m:] + EXTRA) / self.shape_total()[w.shapes[m:]])
        out[:m] = np.log10(w.n[:m] / np.maximum(self.tokens_of_class()[self.of[:m]], 1))
        return out

    def bases(self) -> np.ndarray:
        """Per place: log10 of the token's own share; 0 for the shapes."""
        w = self.words
        out = np.zeros(len(w.words) + SHAPES + 1)
        out[:len(w.words)] = np.log10((w.n + EXTRA) / self.base_total())
        out[-1] = np.log10((w.ends + EXTRA) / self.base_total())
        return out


def train(spark: SparkSession, docs: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model from the rows (doc_id, text) whose fold is not held out."""
    texts = docs.filter(fold(F.col("doc_id")) != HELD_OUT)
    counts, path = written(spark, count_words(texts), "word-counts")
    words = look_up(counts)
    near, near_path = written(spark, count_neighbours(texts, words), "neighbours")
    rows, rows_path = written(spark, profiles(near), "profiles")
    of, matrix, seen = exchange(rows, words.clustered(), rounds)
    remove(spark, near_path)
    remove(spark, rows_path)
    return Model(words, of, matrix, seen, path)


_SCORED = "rid bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, " \
          "rest array<struct<word:binary,shape:int,n:bigint>>"


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""
    words = model.words
    unit_class = model.of[words.units()]
    # one array per place, so scoring a text is looking up
    of, emission, base, step = unit_class, model.emissions(), model.bases(), model.transitions()
    vocabulary, n_words, end = words.words, len(words.words), len(words.words) + SHAPES
    known_end = int(words.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, last = Places(vocabulary), of[end]
        for b in batches:
            out = []
            for t in b.column("text"):
                tokens = known = 0
                total, own, before, rest = 0.0, 0.0, last, Counter()
                for some in word_lists(t.as_py()):
                    if not some:
                        continue
                    at = np.fromiter(map(places.__getitem__, some), np.int64, len(some))
                    c = of[at]
                    total += float(step[np.concatenate(([before], c[:-1])), c].sum() + emission[at].sum())
                    own += float(base[at].sum())
                    before = c[-1]
                    missing = np.flatnonzero(at >= n_words)
                    tokens, known = tokens + len(some), known + len(some) - len(missing)
                    rest.update((key(some[i]), int(at[i]) - n_words) for i in missing)
                total += float(step[before, last])
                own += float(base[end])
                out.append((tokens + 1, known + known_end, own, total, [(w, s, n) for (w, s), n in rest.items()]))
            tokens, known, own, total, rest = zip(*out) if out else ([],) * 5
            kinds = pa.list_(pa.struct([("word", pa.binary()), ("shape", pa.int32()), ("n", pa.int64())]))
            yield pa.record_batch([b.column("rid"), b.column("doc_id"), b.column("held_out"), pa.array(tokens, pa.int64()),
                                   pa.array(known, pa.int64()), pa.array(own, pa.float64()), pa.array(total, pa.float64()),
                                   pa.array([[{"word": w, "shape": s, "n": n} for w, s, n in r] for r in rest], kinds)],
                                  names=["rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rest"])

    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    rows, _ = written(spark, docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                                         held, "text").mapInArrow(run, _SCORED), "scored")
    # Words that are not looked up meet their counts; unknown ones meet none.
    counts = spark.read.schema("word binary, n bigint").parquet(model.counts).withColumnRenamed("n", "c")
    rest = rows.select("rid", F.inline("rest")).join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0)) + EXTRA
    total = F.element_at(F.array(*[F.lit(float(x)) for x in model.shape_total()]), F.col("shape") + 1)
    rest = rest.select("rid", F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"),
                       F.lit(0).cast("bigint").alias("n_tokens"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"),
                       (F.col("n") * F.log10(c / model.base_total())).alias("base"), (F.col("n") * F.log10(c / total)).alias("score"))
    return rows.drop("rest").unionByName(rest).groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score")).drop("rid") \
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


# ----- classes for every word ----------------------------------------------------------

_CODED = "rid bigint, doc_id bigint, held_out boolean, learned boolean, n_tokens bigint, codes binary, " \
         "rest array<struct<word:binary,shape:int>>"
C = CLASSES + SHAPES + 1
ITSELF = C                           # as a neighbour: the word itself
TRIES = 4                            # halvings of the words that move, if the likelihood falls
CHUNK = 1_024                        # words asked at a time
CODE_BITS = 14                       # (C + 1)^2 codes


def code_texts(docs: DataFrame, words: Words) -> DataFrame:
    """Every row with its tokens as places (int32), the end last.

    The words that are not looked up are listed once per row, and numbered after the places.
    """
    vocabulary, n_words = words.words, len(words.words)
    end, places_n = n_words + SHAPES, n_words + SHAPES + 1

    def coded(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        words, sizes = split_words(texts)
        found, row = words.dictionary_encode(), np.repeat(np.arange(len(sizes)), sizes)
        of_token, own = found.indices.to_numpy(), keys(found.dictionary)
        at = pc.fill_null(pc.index_in(own, known), -1).to_numpy()[of_token]
        missing = np.flatnonzero(at < 0)
        n = max(len(own), 1)
        listed, number = np.unique(row[missing] * n + of_token[missing], return_inverse=True)
        per_row = np.bincount(listed // n, minlength=len(sizes))
        at[missing] = places_n + number - (np.cumsum(per_row) - per_row)[row[missing]]
        stops = np.cumsum(sizes + 1)
        seq = np.full(stops[-1], end, "<i4")
        seq[np.arange(len(at)) + row] = at                                  # an end after each row
        rest = pa.StructArray.from_arrays([own.take(pa.array(listed % n)), pa.array(shapes_of(found.dictionary)[listed % n], pa.int32())],
                                          names=["word", "shape"])
        return sizes + 1, binary_rows(seq, stops), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_row)]), pa.int32()), rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.binary())
        for b in batches:
            done = 0
            for texts in blocks(b.column("text")):
                rows = b.slice(done, len(texts))
                done += len(texts)
                sizes, codes, rest = coded(texts, known)
                yield pa.record_batch([*(rows.column(c) for c in ("rid", "doc_id", "held_out", "learned")), pa.array(sizes, pa.int64()),
                                       codes, rest], names=["rid", "doc_id", "held_out", "learned", "n_tokens", "codes", "rest"])

    f = fold(F.col("doc_id"))
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(f == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.coalesce(f != HELD_OUT, F.lit(False)).alias("learned"), "text").mapInArrow(run, _CODED)


def _sequence(b: pa.RecordBatch, rest_sizes: np.ndarray, places: int) -> np.ndarray:
    """The places of a batch's tokens as one sequence, an end before it; other words are numbered through the batch."""
    codes = np.frombuffer(b"".join(b.column("codes").to_pylist()), "<i4").astype(np.int64)
    shift = np.repeat(np.cumsum(rest_sizes) - rest_sizes, b.column("n_tokens").to_numpy())
    return np.concatenate([[places - 1], codes + np.where(codes >= places, shift, 0)])


def _rest(b: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """How many other words each row has, and all of them with their shapes."""
    sizes = b.column("rest").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = b.column("rest").flatten()
    return sizes, flat.field("word"), flat.field("shape").to_numpy(zero_copy_only=False).astype(np.int64)


def coded_neighbours(coded: DataFrame, words: Words) -> DataFrame:
    """``count_neighbours`` of coded texts."""
    units, size, places = words.units(), CLUSTERED + SHAPES + 1, len(words.words) + SHAPES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, _, shapes = _rest(b)
            seq = np.concatenate([units, CLUSTERED + shapes])[_sequence(b, sizes, places)]
            code, n = np.unique(seq[:-1] * size + seq[1:], return_counts=True)
            yield pa.record_batch({"code": code, "n": n})

    return coded.filter("learned").select("n_tokens", "codes", "rest").mapInArrow(run, "code bigint, n bigint") \
        .groupBy("code").agg(F.sum("n").alias("n"))


def contexts(coded: DataFrame, words: Words, of: np.ndarray) -> DataFrame:
    """Rows of words without a class of their own, a word's one after the other in one partition: word, shape, looked (up), and counts.

    A count is 8 bytes, n << CODE_BITS | code. code // (C + 1) is the class before, code % (C + 1) the class after,
    ``ITSELF`` the same word.
    """
    n_words, clustered, places = len(words.words), words.clustered(), len(words.words) + SHAPES + 1
    place_class, vocabulary, vocabulary_shapes = of[words.units()], words.words, words.shapes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.binary())
        for b in batches:
            sizes, others, shapes = _rest(b)
            seq = _sequence(b, sizes, places)
            of_token = np.concatenate([place_class, CLASSES + shapes])[seq]
            at = np.flatnonzero(((seq >= clustered) & (seq < n_words)) | (seq >= places))
            before = np.where(seq[at - 1] == seq[at], ITSELF, of_token[at - 1])
            after = np.where(seq[at + 1] == seq[at], ITSELF, of_token[at + 1])
            # the same word of several rows becomes one
            distinct = others.dictionary_encode()
            number, others = distinct.indices.to_numpy(), distinct.dictionary
            other_shapes = np.zeros(len(others), np.int64)
            other_shapes[number] = shapes
            word = np.concatenate([np.arange(places), n_words + number])[seq[at]]
            both, n = np.unique(word * (C + 1) ** 2 + before * (C + 1) + after, return_counts=True)
            word, code = both // (C + 1) ** 2, both % (C + 1) ** 2
            stops = np.flatnonzero(np.diff(word, append=-1)) + 1
            word = word[stops - 1]
            yield pa.record_batch({"word": pa.concat_arrays([known, others]).take(pa.array(word)),
                                   "shape": pa.array(np.concatenate([vocabulary_shapes, other_shapes])[word], pa.int32()),
                                   "looked": pa.array(word < n_words), "counts": binary_rows(n << CODE_BITS | code, stops)})

    # no such word is more than a 1/CLUSTERED share of the tokens, and none has more than (C + 1)^2 codes
    return coded.filter("learned").select("n_tokens", "codes", "rest") \
        .mapInArrow(run, "word binary, shape int, looked boolean, counts binary").repartition("word").sortWithinPartitions("word")


def _by_row(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of values per row; rows ascend."""
    out = np.zeros((n, *values.shape[1:]))
    if len(rows):
        start = np.flatnonzero(np.diff(rows, prepend=-1))
        out[rows[start]] = np.add.reduceat(values, start, axis=0)
    return out


def best_classes(m: np.ndarray, own: np.ndarray, after: np.ndarray, before: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``best_class`` of many words, each now in the class ``own`` >= CLASSES: where to, and the gain over staying.

    ``after`` and ``before`` are counts of other words by class, a row per word; ``same`` of the word beside itself.
    """
    m, w, k = m.astype(np.float64), len(own), CLASSES
    out, into, rows = m.sum(1), m.sum(0), np.arange(w)
    n_out, n_in = after.sum(1) + same, before.sum(1) + same
    gain = np.zeros((w, k))
    # Without the word itself, only the row and the column of its own class are less.
    for side, other, cells in ((after, before, m.T), (before, after, m)):
        x, j = np.nonzero(side)
        n = side[x, j]
        # equal counts beside the same class gain alike
        kinds, kind = np.unique(n.astype(np.int64) * C + j, return_inverse=True)
        base = cells[kinds % C, :k]
        more = (xlogx(base + (kinds // C)[:, None]) - xlogx(base))[kind]
        mine = np.flatnonzero(j == own[x])
        base = cells[j[mine], :k] - other[x[mine], :k]
        more[mine] = xlogx(base + n[mine][:, None]) - xlogx(base)
        gain += _by_row(x, more, w)
    x, j = np.nonzero((after[:, :k] + before[:, :k] + same[:, None]) > 0)          # else nothing
    d, a, b, s = m[j, j], after[x, j], before[x, j], same[x]
    gain[x, j] += xlogx(d + a + b + s) + xlogx(d) - xlogx(d + a) - xlogx(d + b)
    pairs, pair = np.unique(n_out.astype(np.int64) * (int(n_in.max(initial=0)) + 1) + n_in.astype(np.int64), return_inverse=True)
    n_both = [x[:, None].astype(np.float64) for x in divmod(pairs, int(n_in.max(initial=0)) + 1)]
    gain -= (xlogx(out[:k] + n_both[0]) - xlogx(out[:k]) + xlogx(into[:k] + n_both[1]) - xlogx(into[:k]))[pair]
    stay = np.zeros(w)
    a, b = after[rows, own], before[rows, own]
    d = m[own, own] - a - b - same
    for side, cells in ((after, m.T), (before, m)):
        x, j = np.nonzero(side)
        base = np.where(j == own[x], d[x], cells[j, own[x]] - side[x, j])
        stay += _by_row(x, xlogx(base + side[x, j]) - xlogx(base), w)
    stay += xlogx(d + a + b + same) + xlogx(d) - xlogx(d + a) - xlogx(d + b)
    stay -= xlogx(out[own]) - xlogx(out[own] - n_out) + xlogx(into[own]) - xlogx(into[own] - n_in)
    to = gain.argmax(1)
    return to, gain[rows, to] - stay


def _counts(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts per row, then the code and n of each."""
    both = np.frombuffer(b"".join(rows.column("counts").to_pylist()), "<i8")
    return pc.binary_length(rows.column("counts")).to_numpy().astype(np.int64) // 8, both & ((1 << CODE_BITS) - 1), both >> CODE_BITS


def _one(rows: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of one word as one."""
    if rows.num_rows == 1:
        return rows
    _, code, n = _counts(rows)
    code, at = np.unique(code, return_inverse=True)
    total = np.zeros(len(code), np.int64)
    np.add.at(total, at, n)
    counts = binary_rows(total << CODE_BITS | code, np.array([len(code)]))
    return pa.record_batch([*rows.slice(0, 1).columns[:3], counts], names=["word", "shape", "looked", "counts"])


def choose_classes(of_words: DataFrame, m: np.ndarray) -> DataFrame:
    """word, shape, looked, n, class: that which raises the likelihood most, or the word's shape."""
    def chosen(rows: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
        first, w = rows.take(pa.array(start)), len(start)
        sizes, code, n = _counts(rows)
        x = np.repeat(np.repeat(np.arange(w), np.diff(start, append=rows.num_rows)), sizes)
        side = [np.bincount(x * (C + 1) + c, n, w * (C + 1)).reshape(w, C + 1) for c in (code % (C + 1), code // (C + 1))]
        own = CLASSES + first.column("shape").to_numpy().astype(np.int64)
        to, gain = best_classes(m, own, side[0][:, :C], side[1][:, :C], side[0][:, ITSELF])
        return pa.record_batch([first.column("word"), first.column("shape"), first.column("looked"),
                                pa.array(np.bincount(x, n, w).astype(np.int64)),
                                pa.array(np.where(gain > 1e-6, to, own), pa.int32())],
                               names=["word", "shape", "looked", "n", "class"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None                                                     # the word whose rows may go on
        for b in batches:
            if not b.num_rows:
                continue
            b = b if last is None else pa.concat_batches([last, b])
            word = b.column("word")
            start = np.flatnonzero(np.concatenate([[True], pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)]))
            for i in range(0, len(start) - 1, CHUNK):
                end = min(i + CHUNK, len(start) - 1)
                yield chosen(b.slice(start[i], start[end] - start[i]), start[i:end] - start[i])
            last = _one(b.slice(start[-1]))
        if last is not None:
            yield chosen(last, np.array([0]))

    return of_words.mapInArrow(run, "word binary, shape int, looked boolean, n bigint, class int")


@dataclass
class WholeModel(Model):
    """A model in which every word has been asked for its class; ``texts`` is the table of all rows as classes."""

    place_class: np.ndarray               # class per place
    left: np.ndarray                      # different words per shape that stay there
    texts: DataFrame

    def unclustered(self) -> np.ndarray:
        return self.left


_CLASSED = "rid bigint, doc_id bigint, held_out boolean, learned boolean, n_tokens bigint, n_known bigint, base double, own double, classes binary"


def _class_texts(coded: DataFrame, found: DataFrame, words: Words, place_class: np.ndarray, base_total: float) -> DataFrame:
    """Every row with a byte per token, its class, and the sums that need no class matrix.

    ``own`` is the sum of log10 of the words' counts (with ``EXTRA`` in a shape class), not yet divided by their classes'.
    """
    n_words, places = len(words.words), len(words.words) + SHAPES + 1
    counted = np.concatenate([words.n, np.zeros(SHAPES), [words.ends]])

    def numerators(n: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return np.log10(np.where(cls < CLASSES, np.maximum(n, 1), n + EXTRA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_places, known_places = numerators(counted, place_class), np.ones(places, bool)
        own_places[-1], known_places[-1] = 0, words.ends > 0
        for b in batches:
            if not b.num_rows:
                continue
            sizes = b.column("n_rest").to_numpy().astype(np.int64)
            seq = _sequence(b, sizes, places)[1:]
            flat, m = b.column("found").flatten(), int(sizes.sum())
            lengths = b.column("found").value_lengths().fill_null(0).to_numpy()
            at = flat.field("i").to_numpy(zero_copy_only=False).astype(np.int64) + np.repeat(np.cumsum(sizes) - sizes, lengths)
            cls, n = np.zeros(m, np.int64), np.zeros(m)
            cls[at], n[at] = flat.field("class").to_numpy(zero_copy_only=False), flat.field("n").to_numpy(zero_copy_only=False)
            every = np.concatenate([place_class, cls])
            base = np.log10((np.concatenate([counted, n]) + EXTRA) / base_total)
            own, known = np.concatenate([own_places, numerators(n, cls)]), np.concatenate([known_places, n > 0])
            tokens = b.column("n_tokens").to_numpy()
            start = np.cumsum(tokens) - tokens
            classes = every[seq].astype(np.uint8).tobytes()
            yield pa.record_batch([*(b.column(c) for c in ("rid", "doc_id", "held_out", "learned", "n_tokens")),
                                   pa.array(np.add.reduceat(known[seq].astype(np.int64), start)),
                                   pa.array(np.add.reduceat(base[seq], start)), pa.array(np.add.reduceat(own[seq], start)),
                                   pa.array([classes[i:i + k] for i, k in zip(start.tolist(), tokens.tolist())], pa.binary())],
                                  names=["rid", "doc_id", "held_out", "learned", "n_tokens", "n_known", "base", "own", "classes"])

    wanted = coded.select("rid", F.posexplode("rest").alias("i", "x")).select("rid", "i", "x.word", "x.shape")
    met = wanted.join(found, "word", "left").select("rid", F.struct(
        "i", F.coalesce("class", F.col("shape") + CLASSES).alias("class"), F.coalesce("n", F.lit(0)).alias("n")).alias("x")) \
        .groupBy("rid").agg(F.collect_list("x").alias("found"))
    rows = coded.withColumn("n_rest", F.size("rest")).drop("rest")
    return rows.join(met, "rid", "left").select("rid", "doc_id", "held_out", "learned", "n_tokens", "codes", "n_rest", "found") \
        .mapInArrow(run, _CLASSED)


def _classes(b: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join([bytes([C - 1]), *b.column("classes").to_pylist()]), np.uint8).astype(np.int64)


def text_matrix(texts: DataFrame) -> np.ndarray:
    """Counts of class after class over the training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros(C * C, "<i8")
        for b in batches:
            seq = _classes(b)
            m += np.bincount(seq[:-1] * C + seq[1:], minlength=C * C)
        at = np.flatnonzero(m)
        yield pa.record_batch({"at": pa.array(at), "n": pa.array(m[at])})

    out = np.zeros(C * C, np.int64)
    for r in texts.filter("learned").select("classes").mapInArrow(run, "at bigint, n bigint") \
            .groupBy("at").agg(F.sum("n").alias("n")).collect():                       # at most C * C rows
        out[r["at"]] = r["n"]
    return out.reshape(C, C)


def train_whole(spark: SparkSession, docs: DataFrame, rounds: int = ROUNDS) -> WholeModel:
    """A model from the rows (doc_id, text) whose fold is not held out, with a class for every word that gains by one."""
    counts, counts_path = written(spark, count_words(docs.filter(fold(F.col("doc_id")) != HELD_OUT)), "word-counts")
    words = look_up(counts)
    coded, coded_path = written(spark, code_texts(docs, words), "coded")
    near, near_path = written(spark, coded_neighbours(coded, words), "neighbours")
    rows, rows_path = written(spark, profiles(near), "profiles")
    of, matrix, seen = exchange(rows, words.clustered(), rounds)
    before = likelihood(matrix)
    chosen, chosen_path = written(spark, choose_classes(contexts(coded, words, of), matrix), "word-classes")
    place = {w: i for i, w in enumerate(words.words)}
    base_total = words.tokens + EXTRA * (words.distinct + 1)
    for t in range(TRIES + 1):
        # All words that gain move at once. If the likelihood falls, half as many do, and none in the end.
        moves = F.pmod(F.xxhash64("word"), F.lit(1 << TRIES)) < ((1 << TRIES) >> t if t < TRIES else 0)
        now = chosen.withColumn("class", F.when(moves, F.col("class")).otherwise(F.col("shape") + CLASSES))
        place_class = of[words.units()]
        for r in now.filter("looked").select("word", "class").toLocalIterator():        # at most LOOKUP rows
            place_class[place[bytes(r["word"])]] = r["class"]
        left = np.zeros(SHAPES, np.int64)
        for r in now.filter(F.col("class") >= CLASSES).groupBy("class").agg(F.count(F.lit(1)).alias("v")).collect():   # SHAPES rows
            left[r["class"] - CLASSES] = r["v"]
        found = now.filter("not looked").select("word", "class", "n")
        texts, texts_path = written(spark, _class_texts(coded, found, words, place_class, base_total), "classed")
        matrix = text_matrix(texts)
        if t == TRIES or likelihood(matrix) >= before:
            break
        remove(spark, texts_path)
    for path in (counts_path, coded_path, near_path, rows_path, chosen_path):
        remove(spark, path)
    return WholeModel(words, of, matrix, [*seen, likelihood(matrix)], "", place_class, left, texts)


def score_whole(model: WholeModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every row."""
    step, tokens = model.transitions(), model.words.tokens
    # the end is alone in its class
    total = np.log10(np.concatenate([np.maximum(model.tokens_of_class()[:CLASSES], 1), model.shape_total(), [1]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            seq, n = _classes(b), b.column("n_tokens").to_numpy()
            own = b.column("own").to_numpy() + np.add.reduceat(step[seq[:-1], seq[1:]] - total[seq[1:]], np.cumsum(n) - n)
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), b.column("n_tokens"), b.column("n_known"),
                                   pa.array(np.full(len(n), tokens)), b.column("base"), pa.array(own), pa.array(10 ** (-own / n))],
                                  names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    return model.texts.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                  "base_score double, score double, perplexity double")


def q_class_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_whole(train_whole(spark, docs))
