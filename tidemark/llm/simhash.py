"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint has a bit for every position that is set in over half the hashes of
the document's word shingles. Two fingerprints are linked if at most ``distance``
bits differ. The 64 bits are split into partitions; if partition i is searched
with radius t_i and sum(t_i + 1) = distance + 1, every linked pair is within t_i
in some partition, so probing them finds all links.

* The grouping puts correlated bits into one partition (their second moments
  over all fingerprints), because then the other partitions stay close to
  independent.
* The number of partitions and the radii, which may differ and leave a partition
  out, come from dynamic programming over estimated costs: probes per fingerprint, and
  candidates per fingerprint. The distance of two random fingerprints in a
  partition has a mean and a variance that follow exactly from the same moments; a
  beta-binomial distribution with these gives the chance of a candidate.
* Every fingerprint is indexed once per partition and probes with all masks of at
  most t_i flipped bits. Candidates are verified inside the join, so only true
  links leave it.

Scale: equal fingerprints are collapsed before anything is joined, and again joined
to their documents at the end, where Spark splits a hot fingerprint. The join's
keys are (partition, bits); a bucket that many fingerprints share is split by
Spark's skew handling of both sides. More fingerprints lead to fewer, wider
partitions, which keeps candidates per fingerprint bounded. Components are computed on
fingerprints by rounds of stars; nothing but 64 x 64 moments reaches the driver.

Defined results: null, empty and blank texts have no words and fingerprint zero, which
links like any other; repeated rows share fingerprint and component and keep a row each;
a null doc_id keeps its row and never names a component (unless all of its
component are null, then it is null); an empty table gives no rows; extra columns are
ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from tidemark.llm.common import table, written
from tidemark.llm.components import components

BITS = 64
SEED = 42
# Cost of checking a candidate, in units of writing, shuffling and sorting one probe.
CANDIDATE_COST = 0.03
MAX_PROBES = 2_000


def fingerprint(text: str | None, shingle: int = 4, distinct: bool = False) -> int:
    """Bits over the shingles of ``shingle`` words (``distinct``: every shingle counts once)."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()     # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        pieces = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        begin = np.concatenate([[0], ends[:len(words) - shingle]])
        pieces = [joined[a:z] for a, z in zip(begin.tolist(), (ends[shingle - 1:] - 1).tolist())]
    if distinct:
        pieces = list(set(pieces))
    hash_ = xxhash.xxh64_intdigest
    h = np.array([hash_(p, SEED) for p in pieces], ">u8")
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprint_udf(shingle: int, distinct: bool = False):
    @F.arrow_udf(LongType())
    def fp(text: pa.Array) -> pa.Array:
        out = np.array([fingerprint(t, shingle, distinct) for t in text.to_pylist()], np.uint64)
        return pa.array(out.view(np.int64), pa.int64())
    return fp


# ---- choosing the partitions ----------------------------------------------

def moments(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and E[s_i s_j] of their bits as -1/+1 (the diagonal holds E[s_i])."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both, one = 0, np.zeros((BITS, BITS)), np.zeros(BITS)
        for b in batches:
            v = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).astype(">i8")
            for a in range(0, len(v), 1 << 14):
                s = 2.0 * np.unpackbits(v[a:a + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1) - 1
                both += s.T @ s
                one += s.sum(axis=0)
                n += len(s)
        both[np.diag_indices(BITS)] = one
        i, j = np.triu_indices(BITS)
        yield pa.record_batch({"i": np.append(i, -1), "j": np.append(j, -1), "v": np.append(both[i, j], n)})

    n, m = 0, np.zeros((BITS, BITS))
    for r in prints.select("fp").mapInArrow(run, "i bigint, j bigint, v double").groupBy("i", "j") \
            .agg(F.sum("v").alias("v")).collect():                      # 64 * 65 / 2 + 1 rows at most
        if r["i"] < 0:
            n = int(r["v"])
        else:
            m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["v"]
    return n, m / max(n, 1)


def group_bits(m: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of bits of nearly equal size; each grows from its strongest pair by correlation."""
    mean = np.diag(m)
    cov = m - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(1 - mean ** 2, 1e-9))
    corr = np.abs(cov) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        group = [left[int(np.argmax(corr[np.ix_(left, left)].sum(axis=1)))]]
        while len(group) < size:
            rest = [b for b in left if b not in group]
            group.append(rest[int(np.argmax(corr[np.ix_(rest, group)].mean(axis=1)))])
        left = [b for b in left if b not in group]
        groups.append(sorted(group))
    return groups


def within(m: np.ndarray, bits: list[int], radius: int) -> float:
    """Chance that two random fingerprints differ in at most ``radius`` of ``bits``."""
    w, mean = len(bits), np.diag(m)[bits]
    p = float(((1 - mean ** 2) / 2).mean())
    if p <= 0:
        return 1.0
    sub = m[np.ix_(bits, bits)].copy()
    np.fill_diagonal(sub, 1.0)
    variance = float((sub ** 2 - np.outer(mean ** 2, mean ** 2)).sum()) / 4
    rho = min(max((variance / (w * p * (1 - p)) - 1) / max(w - 1, 1), 1e-6), 0.9)
    a, b = p * (1 / rho - 1), (1 - p) * (1 / rho - 1)
    beta = lambda x, y: math.lgamma(x) + math.lgamma(y) - math.lgamma(x + y)
    return min(1.0, sum(math.comb(w, d) * math.exp(beta(d + a, w - d + b) - beta(a, b)) for d in range(radius + 1)))


def plan(n: int, m: np.ndarray, distance: int) -> list[tuple[list[int], int]]:
    """(bits, radius) of the partitions to search, cheapest by the estimate."""
    best: tuple[float, list[tuple[list[int], int]]] = (math.inf, [])
    for parts in range(1, distance + 2):
        groups = group_bits(m, parts)
        # cost[u] of the first partitions holding u of the distance + 1 units; a radius takes radius + 1 units
        cost: list[tuple[float, list[int]]] = [(0.0, [])] + [(math.inf, [])] * (distance + 1)
        for g in groups:
            own = [0.0]
            for units in range(1, distance + 2):
                probes = sum(math.comb(len(g), r) for r in range(units))
                own.append(math.inf if probes > MAX_PROBES
                           else 1 + probes + CANDIDATE_COST * n * within(m, g, units - 1))
            cost = [min(((cost[s - u][0] + own[u], [*cost[s - u][1], u]) for u in range(s + 1)
                         if cost[s - u][0] < math.inf), default=(math.inf, [])) for s in range(distance + 2)]
        total, units = cost[distance + 1]
        if total < best[0]:
            best = (total, [(g, u - 1) for g, u in zip(groups, units) if u])
    return best[1]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _mask(bits) -> int:
    """Bit i counts from the most significant one, as in ``moments``."""
    return sum(1 << (BITS - 1 - b) for b in bits)


def _probes(part: int, key: Column, flips: list[int]) -> Column:
    return F.transform(F.array(*[F.lit(f) for f in flips]),
                       lambda f: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(f).alias("bits")))


def links(prints: DataFrame, distance: int, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints ``fp`` that differ in 1 to ``distance`` bits."""
    index, probe = [], []
    for k, (bits, radius) in enumerate(partitions):
        flips = [_signed(_mask(c)) for r in range(radius + 1) for c in combinations(bits, r)]
        key = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))))
        index.append(F.struct(F.lit(k).alias("part"), key.alias("bits")))
        probe.append(_probes(k, key, flips))
    left = prints.select(F.col("fp").alias("a"), F.explode(F.concat(*probe) if len(probe) > 1 else probe[0]).alias("x")) \
        .select("a", "x.*")
    right = prints.select(F.col("fp").alias("b"), F.explode(F.array(*index)).alias("y")).select("b", "y.*")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    same = [F.col("x.part") == F.col("y.part"), F.col("x.bits") == F.col("y.bits")]
    found = left.alias("x").join(right.alias("y"), reduce(lambda p, q: p & q, same) & (F.col("a") < F.col("b")) & near)
    return found.select("a", "b").distinct()


def fingerprints(spark: SparkSession, docs: DataFrame, shingle: int = 4, distinct: bool = False) -> DataFrame:
    """(doc_id, fp) of every row, written to the shared folder."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), fingerprint_udf(shingle, distinct)("text").alias("fp"))
    return written(spark, rows, "fingerprints")[0]


def find_links(spark: SparkSession, prints: DataFrame, distance: int = 4) -> DataFrame:
    """Links between the distinct fingerprints of ``prints``."""
    unique, _ = written(spark, prints.select("fp").distinct(), "unique-fingerprints")
    n, m = moments(unique)
    if n < 2:
        return spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    return links(unique, distance, plan(n, m, distance))


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the component)."""
    prints = fingerprints(spark, docs, shingle)
    named = components(spark, find_links(spark, prints, distance)).withColumnRenamed("node", "fp")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    of = least.select("fp", "component").join(ids, "component").select("fp", "component_id")
    return prints.join(of, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_simhash(spark, sf_dir):
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


# ---- one document of each group --------------------------------------------
# Near copies by similarity: fingerprints that link, as above, and bands of minhashes of the five-word shingles for
# copies too far apart for that give candidates, and the shingles themselves decide. A minhash sketch preselects
# those of the bands.

SHINGLE, SIMILARITY = 5, 0.8
SKETCH = 256
# A sketch estimates the similarity with a standard error of 0.025 at 0.8; it only leaves out what is more than
# five of them below, so that of a hundred million pairs at 0.8 a handful is lost to it.
SKETCH_MATCHES = int(SKETCH * (SIMILARITY - 0.14))
# Two texts share a bucket if all minhashes of one band agree. At a similarity of 0.8 none of the bands does
# for 7 pairs in a million, (1 - 0.8^5)^30, whatever the table's size.
BAND, BANDS = 5, 30
BUCKET = 2_048          # rows of a bucket compared by one task; larger buckets are split
EXACT_ROWS, EXACT_CHARS = 256, 8 << 20      # of a block of texts compared with each other
_RNG = np.random.default_rng(20240101)
_MULTIPLY = _RNG.integers(1, 1 << 62, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes]) -> np.ndarray:
    """A hash per run of ``SHINGLE`` words, in text order; fewer words are one run."""
    of = {w: xxhash.xxh64_intdigest(w, SEED) for w in set(words)}
    w = np.fromiter(map(of.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    s = np.zeros(n, np.uint64)
    for i in range(min(SHINGLE, len(w))):
        s = (s ^ w[i:i + n]) * _OTHER
        s ^= s >> np.uint64(29)
    return s


def features(text: str | None) -> tuple[bytes, np.ndarray, bytes]:
    """(digest of the words, keys of the bands, sketch); a text without words has no bands."""
    words = _words(text)
    digest = xxhash.xxh128_digest(b" ".join(words), SEED)
    if not words:
        return digest, np.zeros(0, np.int64), bytes(SKETCH)
    s = shingle_hashes(words)
    low = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 1 << 12):
        low = np.minimum(low, (s[a:a + (1 << 12), None] * _MULTIPLY[None, :]).min(axis=0))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low[:BAND * BANDS].reshape(BANDS, BAND).T:
        keys = (keys ^ column) * _OTHER
        keys ^= keys >> np.uint64(29)
    return digest, keys.view(np.int64), ((low * _OTHER) >> np.uint64(56)).astype(np.uint8).tobytes()


_FEATURES = StructType([StructField("digest", BinaryType()), StructField("bands", ArrayType(LongType())),
                        StructField("sketch", BinaryType())])


@F.arrow_udf(_FEATURES)
def _features(text: pa.Array) -> pa.Array:
    rows = [features(t) for t in text.to_pylist()]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.list_(pa.int64()), pa.binary()))],
                                      names=["digest", "bands", "sketch"])


def _alike(sketch: np.ndarray, x: int, at: np.ndarray) -> np.ndarray:
    return at[(sketch[at] == sketch[x]).sum(axis=1) >= SKETCH_MATCHES]


def _forest(alike: Callable[[int, np.ndarray], np.ndarray], top: np.ndarray, ids: list[int], block: np.ndarray,
            i: int, j: int) -> list[tuple[int, int]]:
    """Links that connect the copies of one bucket: at most one fewer than rows.

    ``alike`` picks a row's copies from others, rows of equal ``top`` are connected already. ``block``
    tells the two halves of a split bucket apart; of halves i < j only pairs across are compared.
    """
    rows = np.flatnonzero(block == i)
    columns = np.flatnonzero(block == j)
    found = []
    for x in rows.tolist():
        at = columns[top[columns] != top[x]]
        if i == j:
            at = at[at > x]
        if not len(at):
            continue
        for y in alike(x, at).tolist():
            if top[x] != top[y]:
                top[top == top[y]] = top[x]
                found.append((ids[x], ids[y]))
    return found


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """A row goes to every pair of its bucket's ``blocks`` with its own; pairs lie together and in order."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")}).drop("with", "blocks")
    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "rid")


def _linked(dealt: DataFrame, key: str, forest: Callable[[pa.Table, int, int], list[tuple[int, int]]]) -> DataFrame:
    """(a, b): the links that ``forest`` finds in each pair of blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def same(x: pa.RecordBatch, r: int, y: pa.RecordBatch, q: int) -> bool:
            return all(x.column(c)[r].as_py() == y.column(c)[q].as_py() for c in (key, "i", "j"))

        def flush(bs: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(bs).combine_chunks()
            keys = np.stack([t.column(c).to_numpy().astype(np.int64) for c in (key, "i", "j")])
            cut = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            pairs = []
            for a, z in zip([0, *cut.tolist()], [*cut.tolist(), t.num_rows]):
                if z - a > 1:
                    pairs += forest(t.slice(a, z - a), int(keys[1, a]), int(keys[2, a]))
            return pa.record_batch([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for b in batches:
            if not b.num_rows:
                continue
            if held and not same(held[-1], held[-1].num_rows - 1, b, 0):
                yield flush(held)
                held = []
            # the last bucket of a batch may go on in the next
            last = b.num_rows - 1
            while last > 0 and same(b, last - 1, b, b.num_rows - 1):
                last -= 1
            if last:
                yield flush([*held, b.slice(0, last)])
                held = [b.slice(last)]
            else:
                held.append(b)
        if held:
            yield flush(held)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _sketches(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)


def candidates(reps: DataFrame) -> DataFrame:
    """(a, b): links between ``rid``s that connect all that may be near copies.

    Pairs that share a band's minhashes are preselected by their sketches. Buckets with more
    than ``BUCKET`` rows are cut into blocks and every two blocks are compared by a task of their own.
    """
    keys = reps.select("rid", F.explode("bands").alias("key"))
    # Buckets of one row are left out before the sketches are joined.
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1") \
        .select("key", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks"))
    rows = keys.join(sizes, "key").join(reps.select("rid", "sketch"), "rid")

    def forest(t: pa.Table, i: int, j: int) -> list[tuple[int, int]]:
        sketch = _sketches(t)
        return _forest(lambda x, at: _alike(sketch, x, at), np.arange(t.num_rows), t.column("rid").to_pylist(),
                       t.column("block").to_numpy(), i, j)

    return _linked(_dealt(rows, "key"), "key", forest)


def print_links(spark: SparkSession, reps: DataFrame) -> DataFrame:
    """(a, b): links between ``rid``s that connect all whose fingerprints ``fp`` are equal or link."""
    named, _ = written(spark, reps.groupBy("fp").agg(F.min("rid").alias("least")), "dedup-fingerprints")
    equal = reps.join(named, "fp").filter("rid <> least").select(F.col("least").alias("a"), F.col("rid").alias("b"))
    near = find_links(spark, named) \
        .join(named.select(F.col("fp").alias("a"), F.col("least").alias("first")), "a") \
        .join(named.select(F.col("fp").alias("b"), F.col("least").alias("second")), "b")
    return equal.unionByName(near.select(F.col("first").alias("a"), F.col("second").alias("b")))


def exact_shingles(text: str | None) -> np.ndarray:
    """The hashes of the different shingles in order; a text without words has one of its own."""
    words = _words(text)
    return np.unique(shingle_hashes(words)) if words else np.zeros(1, np.uint64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two ``exact_shingles`` is 0.8 or more, in whole numbers."""
    small, large = sorted((len(a), len(b)))
    if 5 * small < 4 * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 5 * both >= 4 * (small + large - both)


@F.arrow_udf(BooleanType())
def _similar(text: pa.Array, other: pa.Array) -> pa.Array:
    last, held = None, None
    out = []
    for t, o in zip(text, other):
        o = o.as_py()
        if held is None or o != last:
            last, held = o, exact_shingles(o)
        out.append(similar(exact_shingles(t.as_py()), held))
    return pa.array(out, pa.bool_())


def copies(spark: SparkSession, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): links between ``rid``s of a similarity of 0.8 or more that connect every group of near copies.

    The texts (rid, text) of each group of candidates are compared exactly: all with the group's first, which
    settles most, then, where some are no copies of it, those with all others. Groups with more than
    ``EXACT_ROWS`` rows or ``EXACT_CHARS`` characters are cut into blocks, every two of which are a task's.
    """
    loose = components(spark, print_links(spark, reps).unionByName(candidates(reps))).withColumnRenamed("node", "rid")
    member, _ = written(spark, loose.join(reps.select("rid", "sketch"), "rid").join(texts, "rid"), "dedup-members")
    first = member.filter("rid = component").select("component", F.col("text").alias("other"))
    tested, _ = written(spark, member.filter("rid <> component").join(first, "component")
                        .select("rid", "component", _similar("text", "other").alias("near")), "dedup-tested")
    near = tested.filter("near").select("rid", F.col("component").alias("a"))
    # A group of two is settled, and so is one whose members are all copies of the first.
    odd = tested.groupBy("component").agg(F.min("near").alias("all"), F.count(F.lit(1)).alias("n")) \
        .filter("not all and n > 1").select("component")
    open_ = member.join(odd, "component")
    sizes = open_.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")) \
        .select("component", F.ceil(F.greatest(F.col("n") / EXACT_ROWS, F.col("chars") / EXACT_CHARS, F.lit(1)))
                .cast("int").alias("blocks"))
    rows = open_.join(sizes, "component").join(near.select("rid", F.lit(True).alias("core")), "rid", "left") \
        .withColumn("core", F.coalesce("core", F.col("rid") == F.col("component")))

    def forest(t: pa.Table, i: int, j: int) -> list[tuple[int, int]]:
        sketch, text, held = _sketches(t), t.column("text"), {}

        def own(x: int) -> np.ndarray:
            if x not in held:
                held[x] = exact_shingles(text[x].as_py())
            return held[x]

        def alike(x: int, at: np.ndarray) -> np.ndarray:
            return np.array([y for y in _alike(sketch, x, at).tolist() if similar(own(x), own(y))], np.int64)

        # What is a copy of the group's first is connected already.
        core, n = t.column("core").to_numpy(zero_copy_only=False).astype(bool), t.num_rows
        return _forest(alike, np.where(core, n, np.arange(n)), t.column("rid").to_pylist(), t.column("block").to_numpy(), i, j)

    return near.select("a", F.col("rid").alias("b")).unionByName(_linked(_dealt(rows, "component"), "component", forest))


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with one of each group of exact or near copies: that with the smallest doc_id.

    A group is connected by pairs whose five-word shingles have a similarity of ``SIMILARITY`` or
    more, among those that SimHash links and those that meet in a band. Rows are told apart by a number written beside them, so repeated rows are copies, and null
    doc_ids lose to others. The texts are written once, those of candidates once more.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    rows, _ = written(spark, docs.select(own, F.monotonically_increasing_id().alias("rid"), _features("text").alias("f"),
                                         fingerprint_udf(4)("text").alias("fp")), "dedup-rows")
    best = F.struct(F.col("d.doc_id").isNull().alias("none"), F.col("d.doc_id").alias("doc_id"), "rid")
    reps = rows.select("f.*", "fp", best.alias("best")).groupBy("digest", "bands", "sketch", "fp").agg(F.min("best").alias("best"))
    reps, _ = written(spark, reps.withColumn("rid", F.col("best.rid")), "dedup-texts")
    groups = components(spark, copies(spark, reps, rows.select("rid", "d.text")))
    member = reps.select("rid", "best").join(groups.withColumnRenamed("node", "rid"), "rid")
    stays = member.groupBy("component").agg(F.min("best").alias("top")).select(F.col("top.rid").alias("rid"))
    goes = member.select("rid").join(stays, "rid", "left_anti")
    kept = reps.select("rid").join(goes, "rid", "left_anti")
    return rows.join(kept, "rid", "left_semi").select("d.*")
