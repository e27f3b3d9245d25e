"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, runs of non-letters become one space, and n-grams of one
to three characters are hashed to ``DIM`` bins. Document frequencies are counted over all
labelled documents of the training folds. The classifier may see a bounded
sample: about ``MAX_TRAINING`` documents chosen by hash of doc_id, dealt to
``SHARDS`` shards. Every shard runs follow-the-regularised-leader (proximal, with
elastic-net penalties, so most weights are exactly zero); the mean of the shards
is the model. One temperature, fitted on about ``MAX_CALIBRATION`` other documents
of the training folds, calibrates the probabilities.

Scale: two passes over the texts, both without a shuffle of texts. The driver gets
document frequencies (``DIM`` rows), the model of every shard and the logits of the calibration
documents, all bounded by parameters and the number of languages.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no labelled
document everything is ``und`` with score 0; a null doc_id is in no fold, is predicted
and never learned from; a null lang is never learned from; repeated rows are predicted one by
one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

DIM = 1 << 15
FOLDS, HELD_OUT = 4, 2
MAX_TRAINING, MAX_CALIBRATION = 8_000, 2_000
SHARDS, EPOCHS = 8, 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
UNKNOWN = "und"
_CHUNK = 1 << 20
# Per code point: whether it is a letter. Numbers such as ² or Ⅷ, marks, signs and emoji are none.
_ALPHA = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Hashed counts of the text's character n-grams."""
    out = np.zeros(DIM, np.int64)
    text = text.lower()
    for a in range(0, max(len(text), 1), _CHUNK):
        c = np.frombuffer(text[max(0, a - 2):a + _CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        c = np.where(_ALPHA[c], c, 32).astype(np.uint32)
        keep = c != 32
        keep[1:] |= c[:-1] != 32
        c = c[keep]
        h = np.zeros(len(c), np.uint32)
        for n in range(1, 4):
            if len(c) < n:
                break
            h = (h[:len(c) - n + 1] + c[n - 1:]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            out += np.bincount((h + np.uint32(n * 0x85EB)) & np.uint32(DIM - 1), minlength=DIM)
    return out


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bins, values): log term frequency times inverse document frequency, of length 1."""
    n = counts(text)
    at = np.flatnonzero(n)
    x = np.log1p(n[at]) * idf[at]
    size = float(np.sqrt((x * x).sum()))
    return at, x / size if size else x


def softmax(v: np.ndarray) -> np.ndarray:
    e = np.exp(v - v.max())
    return e / e.sum()


def ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (DIM + 1, classes), the last row being the bias, which is not penalised by L1."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))
    l1 = np.full((DIM + 1, 1), L1)
    l1[DIM] = 0
    solve = lambda at: np.where(np.abs(z[at]) <= l1[at], 0.0, -(z[at] - np.sign(z[at]) * l1[at])
                                / ((BETA + np.sqrt(n[at])) / ALPHA + L2))
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for k in order.permutation(len(samples)):
            at, x, y = samples[k]
            at, x = np.append(at, DIM), np.append(x, 1.0)
            w = solve(at)
            p = softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / ALPHA * w
            n[at] = grown
    return solve(np.arange(DIM + 1))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The T that minimises the negative log-likelihood of softmax(logits / T), by golden section on log T.

    Labels are smoothed by one document in all, so separable documents don't drive T to 0.
    """
    if not len(y):
        return 1.0
    smooth = 1.0 / (len(y) + logits.shape[1])

    def loss(log_t: float) -> float:
        v = logits / np.exp(log_t)
        v = v - v.max(axis=1, keepdims=True)
        own = (1 - smooth) * v[np.arange(len(y)), y] + smooth * v.mean(axis=1)
        return float((np.log(np.exp(v).sum(axis=1)) - own).mean())

    a, b, r = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(60):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class Model:
    """Languages, inverse document frequencies, weights and temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray, weights: np.ndarray, t: float = 1.0):
        self.langs, self.idf, self.weights, self.t = langs, idf, weights.astype(np.float32), t

    def logits(self, text: str) -> np.ndarray:
        at, x = vector(text, self.idf)
        return x @ self.weights[at] + self.weights[DIM]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text).astype(np.float64) / self.t)
        k = int(np.argmax(p))
        return self.langs[k], float(p[k])


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS))


def document_frequencies(labelled: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents and, per bin, of documents that have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(DIM, np.int64)
        for b in batches:
            for t in b.column("text").to_pylist():
                df += counts(t) > 0
                n += 1
        at = np.flatnonzero(df)
        yield pa.record_batch({"bin": np.append(at, -1), "n": np.append(df[at], n)})

    n, df = 0, np.zeros(DIM, np.int64)
    for r in labelled.select("text").mapInArrow(run, "bin bigint, n bigint").groupBy("bin") \
            .agg(F.sum("n").alias("n")).collect():                       # DIM + 1 rows at most
        if r["bin"] < 0:
            n = r["n"]
        else:
            df[r["bin"]] = r["n"]
    return n, df


def train(docs: DataFrame, max_training: int = MAX_TRAINING, max_calibration: int = MAX_CALIBRATION) -> Model:
    """A model from rows (doc_id, text, lang) of the training folds."""
    labelled = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    langs = [r["lang"] for r in labelled.groupBy("lang").count().orderBy("lang").collect()]
    if not langs:
        return Model([], np.zeros(DIM), np.zeros((DIM + 1, 1)))
    n, df = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + df)) + 1
    # The sample: two neighbouring stretches of the hash of doc_id.
    scale = 1 << 20
    per_doc = min(1.0, (max_training + max_calibration) / n)
    stop = int(per_doc * scale * max_training / (max_training + max_calibration))
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(scale))
    sample = labelled.withColumns({"place": place, "shard": F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SHARDS))}) \
        .filter(F.col("place") < int(per_doc * scale))
    index = {x: k for k, x in enumerate(langs)}

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "lang"], kind="stable")
        rows = [(*vector(t, idf), index[x]) for t, x in zip(pdf["text"], pdf["lang"]) if has_letter(t)]
        w = ftrl(rows, len(langs))
        return pd.DataFrame({"n": [len(rows)], "weights": [w.astype("<f4").tobytes()]})

    parts = sample.filter(F.col("place") < stop).select("shard", "doc_id", "text", "lang") \
        .groupBy("shard").applyInPandas(learn, "n bigint, weights binary").collect()      # SHARDS rows
    total = sum(r["n"] for r in parts)
    weights = np.zeros((DIM + 1, len(langs)))
    for r in sorted(parts, key=lambda r: (r["n"], r["weights"])):
        weights += np.frombuffer(r["weights"], "<f4").reshape(weights.shape) * (r["n"] / max(total, 1))
    model = Model(langs, idf, weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(index[x], model.logits(t).tolist()) for t, x in
                    zip(b.column("text").to_pylist(), b.column("lang").to_pylist()) if has_letter(t)]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()),
                                   pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["y", "logits"])

    seen = sample.filter(F.col("place") >= stop).select("text", "lang").mapInArrow(score, "y bigint, logits array<double>") \
        .orderBy("y", "logits").collect()                                                # about max_calibration rows
    if seen:
        model.t = temperature(np.array([r["logits"] for r in seen]), np.array([r["y"] for r in seen]))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array([g[0] for g in got], pa.string()),
                                   pa.array([g[1] for g in got], pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    held = F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held, "text") \
        .mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def q_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    return predict(docs, train(docs))
