"""Hard-negative mining by slot-decomposed selection.

An anchor's positives are the best rows of its own label; each positive admits the
negatives whose score lies between two percentages of its own, so the windows of one anchor
overlap. The windows' upper limits split the scores into disjoint slots. Every combiner keeps
the best k of each slot, whatever the windows; the best k of a window are then found by
merging its slot with all lower ones in descending order and stopping at the lower limit. So each score
is looked at once for all windows of an anchor.

Scale: stated anchors against all rows is a block product. Anchors and rows are dealt to
shards of ``ANCHOR_BLOCK`` and ``ROW_BLOCK``; a cell of the grid is one group that meets one shard of
each, multiplies them in pieces and returns at most ``slots * k`` rows per anchor. Per anchor
Spark then ranks within the slot, which it limits before the shuffle. A row is sent once per
``ANCHOR_BLOCK`` anchors, an anchor once per ``ROW_BLOCK`` rows; the driver sees two row counts. Rows are dealt by
their place in the input, so neither a frequent label, id nor vector makes a large shard.

Defined results: rows with a null id, label or vector, or with a null or non-finite component,
take no part. Vectors of unequal length are compared over their common components, an
empty one scores 0 with every row. Equal scores: the smaller id first. Rows of an anchor's id are never its
positives or negatives. Exact repeats of a row count once; rows that share an id but not
the vector are ranked each by itself, and as anchors they have results of their own. A positive
with a negative score has an empty window; one with score 0 admits scores of 0 only. Too few
rows give what there is, an empty table no rows; extra columns are ignored. Components beyond
2**31 after scaling, or scores that 64-bit integers cannot multiply by 100, raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, written

ANCHOR_BLOCK, ROW_BLOCK = 16_384, 32_768
PIECE = 1 << 21                     # scores held at a time, as anchors x rows
MAX_PARTITIONS = 20_000
LIMIT = 2 ** 56                     # 100 times a score has to fit 64 bits


def _matrix(vectors: pa.ChunkedArray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of every component, filled up with zeros to ``width``."""
    v = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    if isinstance(v, pa.ChunkedArray):          # no chunk at all
        return np.zeros((0, width))
    flat = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() > 2 ** 31:
        raise OverflowError("a component is beyond 2**31 after scaling")
    n = np.diff(v.offsets.to_numpy())
    out = np.zeros((len(n), width))
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
    return out


def _width(vectors: pa.ChunkedArray) -> int:
    return max((max(np.diff(c.offsets.to_numpy()), default=0) for c in vectors.chunks), default=0)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of two integral matrices."""
    top = (np.abs(a).max() if a.size else 0) * (np.abs(b).max() if b.size else 0) * a.shape[1]
    if top < 2 ** 53:
        return (a @ b.T).astype(np.int64)                      # exact in doubles
    if top >= LIMIT:
        raise OverflowError("scores are beyond 2**56")
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The best k (score, id) of every group, ties to the smaller id, repeats once."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.score = np.zeros((groups, k), np.int64)
        self.id = np.zeros((groups, k), np.int64)
        self.n = np.zeros(groups, np.int64)

    def cutoff(self) -> np.ndarray:
        """Scores below it cannot enter a group any more."""
        return np.where(self.n == self.k, self.score[:, -1], np.iinfo(np.int64).min)

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        keep = score >= self.cutoff()[group]
        group, score, ident = group[keep], score[keep], ident[keep]
        if not len(group):
            return
        met = np.unique(group)
        held = np.arange(self.k)[None, :] < self.n[met][:, None]
        group = np.concatenate([group, np.repeat(met, self.n[met])])
        score = np.concatenate([score, self.score[met][held]])
        ident = np.concatenate([ident, self.id[met][held]])
        order = np.lexsort((ident, ~score, group))             # ~score: descending without overflow
        group, score, ident = group[order], score[order], ident[order]
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (score[1:] != score[:-1]) | (ident[1:] != ident[:-1])
        group, score, ident = group[new], score[new], ident[new]
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[start, len(group)])
        place = np.arange(len(group)) - np.repeat(start, size)
        top = place < self.k
        self.score[group[top], place[top]] = score[top]
        self.id[group[top], place[top]] = ident[top]
        self.n[group[start]] = np.minimum(size, self.k)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        held = np.arange(self.k)[None, :] < self.n[:, None]
        return np.repeat(np.arange(len(self.n)), self.n), self.score[held], self.id[held]


_FOUND = "anchor_id bigint, anchor_key bigint, slot int, score bigint, id bigint"


def _cell(k: int, scale: int, same_label: bool):
    """The best k per anchor and slot of one shard of anchors in one shard of rows.

    ``limits`` holds an anchor's upper limits in descending order, ``least`` the smallest lower one; without
    limits everything is one slot.
    """
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        width = max(_width(anchors.column("vector")), _width(rows.column("vector")))
        out = []
        whole = [anchors.column(c).to_numpy() for c in ("id", "key", "label")]
        if not same_label:
            least = anchors.column("least").to_numpy()
            limits = anchors.column("limits").to_pylist()
            slots = max(map(len, limits), default=0)
            upper = np.full((len(limits), slots), np.iinfo(np.int64).min)
            for i, x in enumerate(limits):
                upper[i, :len(x)] = x
        else:
            slots = 1
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        matrix, step = _matrix(rows.column("vector"), scale, width), 2_048
        of_anchor = _matrix(anchors.column("vector"), scale, width)
        for a in range(0, anchors.num_rows, PIECE // step):
            part = slice(a, a + PIECE // step)
            aid, akey, alabel = (x[part] for x in whole)
            best = Best(len(aid) * slots, k)
            for b in range(0, len(ids), step):
                s = scores(of_anchor[part], matrix[b:b + step])
                own = alabel[:, None] == labels[None, b:b + step]
                if same_label:
                    own &= (aid[:, None] != ids[None, b:b + step]) & (s >= best.cutoff()[:, None])
                else:
                    # the first upper limit is the largest of all
                    own = ~own & (aid[:, None] != ids[None, b:b + step]) & (s >= least[part, None]) & (s <= upper[part, :1])
                i, j = np.nonzero(own)
                got = s[i, j]
                if same_label:
                    best.add(i, got, ids[b + j])
                else:
                    # the lowest upper limit that still admits the score
                    slot = (got[:, None] <= upper[part][i]).sum(axis=1) - 1
                    best.add(i * slots + slot, got, ids[b + j])
            g, s, who = best.rows()
            out.append(pa.table({"anchor_id": aid[g // slots], "anchor_key": akey[g // slots],
                                 "slot": (g % slots).astype(np.int32), "score": s, "id": who}))
        return pa.concat_tables(out) if out else pa.table(
            {"anchor_id": pa.array([], pa.int64()), "anchor_key": pa.array([], pa.int64()),
             "slot": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
    return run


def _best_of_grid(anchors: DataFrame, rows: DataFrame, shards: tuple[int, int], k: int, scale: int,
                  same_label: bool) -> DataFrame:
    """(anchor_id, anchor_key, slot, score, id): the best k per anchor and slot over all rows."""
    n_a, n_r = shards
    parts = min(n_a * n_r, MAX_PARTITIONS)
    place = F.monotonically_increasing_id()
    # every shard of one side meets every shard of the other: cell = anchor shard * n_r + row shard
    own = anchors.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_r - 1)))) \
        .withColumn("cell", F.pmod("key", F.lit(n_a)) * n_r + F.col("cell")).repartition(parts, "cell")
    all_rows = rows.withColumn("_shard", F.pmod(F.xxhash64(place), F.lit(n_r))) \
        .withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_a - 1)))) \
        .withColumn("cell", (F.col("cell") * n_r + F.col("_shard")).cast("bigint")).drop("_shard").repartition(parts, "cell")
    found = own.groupBy("cell").cogroup(all_rows.groupBy("cell")).applyInArrow(_cell(k, scale, same_label), _FOUND)
    first = F.row_number().over(Window.partitionBy("anchor_id", "anchor_key", "slot").orderBy(F.desc("score"), "id"))
    # the same row may be repeated in several cells
    return found.distinct().withColumn("_n", first).filter(F.col("_n") <= k).drop("_n")


def mine(spark: SparkSession, rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has id, label and vector; ``is_anchor`` is a condition on them. For every anchor, and each of
    its best ``positives`` rows of the same label, the best ``negatives`` rows of another label
    whose score is ``low`` to ``high`` percent of the positive's.
    """
    x = lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))  # noqa: E731 (NaN is above infinity)
    rows = rows.select(F.col("id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), "vector") \
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", x))
    anchors = rows.filter(is_anchor).distinct().withColumn("key", F.xxhash64("label", "vector"))
    anchors, _ = written(spark, anchors, "anchors")
    n_anchors, n_rows = anchors.count(), rows.count()
    lanes = spark.sparkContext.defaultParallelism
    # small inputs are dealt to all cores; a shard never exceeds its block
    n_a = max(1, -(-n_anchors // ANCHOR_BLOCK))
    n_r = max(1, -(-n_rows // ROW_BLOCK), min(lanes // n_a, n_rows // 2_048))
    shards = (n_a, n_r)

    same = _best_of_grid(anchors, rows, shards, positives, scale, True).drop("slot")
    same, _ = written(spark, same, "positives")
    windows = same.withColumn("upper", F.expr(f"score * {high} div 100")) \
        .withColumn("lower", F.expr(f"(score * {low} + 99) div 100")).filter("score >= 0 AND lower <= upper")
    limits = windows.groupBy("anchor_id", "anchor_key").agg(
        F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("least"))
    asked = anchors.join(limits.select(F.col("anchor_id").alias("id"), F.col("anchor_key").alias("key"), "limits", "least"),
                         ["id", "key"])
    found = _best_of_grid(asked, rows, shards, negatives, scale, False)
    # at most slots * negatives rows per anchor, best first: a window is the stretch from its
    # upper limit down to its lower one
    suffixes = found.groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(F.struct(
        F.negative("score").alias("down"), "id"))).alias("found"))
    inside = lambda c: (-c["down"] <= F.col("upper")) & (-c["down"] >= F.col("lower"))
    return windows.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}) \
        .join(suffixes, ["anchor_id", "anchor_key"]) \
        .select("anchor_id", "positive_id", "positive_score",
                F.posexplode(F.slice(F.filter("found", inside), 1, negatives)).alias("place", "hit")) \
        .select("anchor_id", "positive_id", (F.col("place") + 1).cast("int").alias("rank"),
                F.col("hit.id").alias("negative_id"), "positive_score", (-F.col("hit.down")).alias("negative_score"))


def q_hard_negatives(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = e.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return mine(spark, rows, F.col("id") % 50 == 0)


SQL = """WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, v.vec_id AS id, a.label = v.label AS own, list_inner_product(a.e, v.e)::BIGINT AS score
      FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
w AS (SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)::INT AS rank
      FROM p JOIN s AS n ON n.anchor_id = p.anchor_id AND NOT n.own
       AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3"""
