r"""Secret scans with a linear-chain conditional random field.

The base patterns (assignments, access keys, hexadecimal strings) find what has
a known form. The field adds what they miss: it tags the tokens of a line as
secret begin (B), inside (I) or outside (O), from their shape, their neighbours' words
and features of the file, decoded by Viterbi. Its labels are the base patterns'
own findings in a bounded sample, and the same lines with the findings in other forms and under other
names, and with harmless long tokens in their place (``variations``), so it learns what secrets look like
and what stands near them beyond the patterns. Other long tokens of those lines have no label: their
tags are summed over in training, since no pattern says that they are no secrets.

Only a token with a digit among ``LEAST`` or more letters, digits and ``+/_=-`` may
begin a secret, and only tokens of such letters may continue one. That is a rule of the
field (other tags score minus infinity), so a line without such a token is outside
throughout and need not be decoded: whole texts are scanned, but few lines cost more
than a search.

A span is kind, start, end in code points, end exclusive. Base spans stay; a span of the
field is dropped only if it lies inside one base span. Of spans that overlap the union is masked.

Scale: one pass over the texts in which nothing is shuffled, after training on the lines of
about ``MAX_TRAINING`` documents chosen by hash (the classifier's documented bound), dealt to
``SHARDS`` shards whose weights are averaged; weights are ``DIM`` x 3, whatever the input.

Defined results: null and empty texts have no spans; repeated rows and null doc_ids are
scanned row by row; without any secret in the sample the field adds nothing; an empty
table gives no rows; extra columns are ignored (and kept by ``redact``).
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import table

# The base patterns of the contract (letters of the first in either case).
_ANY_CASE = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
ASSIGN = re.compile("(" + "|".join(map(_ANY_CASE, ("password", "passwd", "secret", "token", "api_?key")))
                    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
ASSIGN_NAME = re.compile("|".join(map(_ANY_CASE, ("password", "passwd", "secret", "token", "api_?key"))))
KINDS = ("assign", "access", "hex")
FIELD = "crf"

LEAST = 12
MAX_TRAINING, SHARDS, EPOCHS, RATE = 20_000, 4, 3, 0.2
STRETCH, STRETCHES = 512, 32       # tokens of a line learned at once; stretches a document teaches at most, drawn by hash
MAX_STRETCHES = 4_000              # of a shard
NEAR, VARIATIONS = 12, 6           # tokens on each side of a secret in a variation; real and harmless ones per secret
DIM = 1 << 13
O, B, I = 0, 1, 2  # noqa: E741
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{12,}")        # LEAST and more; whole runs, so a search is linear
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+|[^\W]+|[^\s]")
_SOLID = re.compile(r"[A-Za-z0-9+/_=-]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each pattern that do not overlap others of their kind, by start, then kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# A whole run of hexadecimal digits of 16 or more: the same matches as HEX with the short ones dropped.
_LONG_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}")


# ---- the field -------------------------------------------------------------

def can_begin(token: str) -> bool:
    return len(token) >= LEAST and _SOLID.fullmatch(token) is not None and any("0" <= c <= "9" for c in token)


def shape(token: str) -> str:
    out = []
    for c in token[:64]:
        k = "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "+" if c in "+/=" else "p"
        if not out or out[-1] != k:
            out.append(k)
    return "".join(out[:8]) + ("*" if len(out) > 8 else "")


def _known_words(token: str) -> str:
    return token.lower() if len(token) <= 16 and not can_begin(token) else "<long>"


def file_features(text: str) -> list[str]:
    n = max(len(text), 1)
    return [f"file:braces{min(3, 100 * (text.count('{') + text.count(';')) // n)}",
            f"file:equals{min(3, 200 * text.count('=') // n)}", f"file:lines{min(4, len(text).bit_length() // 4)}"]


def token_features(tokens: list[str], i: int, of_file: list[str]) -> list[int]:
    """Hashed features of a token: shape, neighbouring words, file."""
    t = tokens[i]
    f = ["bias", "solid" if _SOLID.fullmatch(t) else "loose"]
    if can_begin(t):
        digits = sum(c.isdigit() for c in t)
        entropy = -sum(k / len(t) * np.log2(k / len(t)) for k in (t.count(c) for c in set(t)))
        f += ["begin", "shape:" + shape(t), f"len:{min(len(t) // 8, 8)}", f"digits:{10 * digits // len(t)}",
              f"entropy:{int(2 * entropy)}", "hex" if HEX.fullmatch(t) else "nothex", *of_file]
    else:
        f += ["w:" + _known_words(t)]
    for d in (-3, -2, -1, 1):
        f.append(f"{d}:" + (_known_words(tokens[i + d]) if 0 <= i + d < len(tokens) else "<edge>"))
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % DIM for x in f]


def allowed(tokens: list[str]) -> np.ndarray:
    """(n, 3): whether a token may have the tag."""
    return np.array([(True, can_begin(t), _SOLID.fullmatch(t) is not None) for t in tokens], bool).reshape(-1, 3)


_NEVER = -1e9
# Outside cannot be followed by inside.
_STEP = np.array([[0, 0, _NEVER], [0, 0, 0], [0, 0, 0]], float)
_FIRST = np.array([0, 0, _NEVER], float)


def _scores(features: list[list[int]], legal: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.where(legal, np.array([w[f].sum(axis=0) for f in features]).reshape(-1, 3), _NEVER)


def viterbi(scores: np.ndarray, step: np.ndarray) -> list[int]:
    best, back = scores[0] + _FIRST, []
    for s in scores[1:]:
        via = best[:, None] + step + _STEP
        back.append(via.argmax(axis=0))
        best = via.max(axis=0) + s
    tags = [int(best.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return tags[::-1]


def _logsum(v: np.ndarray, axis: int) -> np.ndarray:
    m = v.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(v - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(scores: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag probabilities (n, 3) and expected transitions (3, 3), by forward and backward sums."""
    n, full = len(scores), step + _STEP
    a, b = np.empty((n, 3)), np.zeros((n, 3))
    a[0] = scores[0] + _FIRST
    for i in range(1, n):
        a[i] = scores[i] + _logsum(a[i - 1][:, None] + full, 0)
    for i in range(n - 2, -1, -1):
        b[i] = _logsum(full + (scores[i + 1] + b[i + 1])[None, :], 1)
    z = _logsum(a[-1], 0)
    pairs = np.zeros((3, 3))
    for i in range(n - 1):
        pairs += np.exp(a[i][:, None] + full + (scores[i + 1] + b[i + 1])[None, :] - z)
    return np.exp(a + b - z), pairs


def lines_of(text: str) -> Iterator[tuple[int, str]]:
    """(start, line) of the lines that hold a token which may begin a secret."""
    at = 0
    for line in text.split("\n"):
        if any(_DIGIT.search(line, m.start(), m.end()) for m in _RUN.finditer(line)):
            yield at, line
        at += len(line) + 1


def tokenize(line: str) -> tuple[list[str], list[int]]:
    found = list(_TOKEN.finditer(line))
    return [m.group() for m in found], [m.start() for m in found]


def labels(tokens: list[str], starts: list[int], spans: list[Span]) -> list[int]:
    """Tags of tokens that lie in the secret part of a base span."""
    tags = [O] * len(tokens)
    for _, a, z in spans:
        first, i = True, bisect_left(starts, a)
        while i < len(tokens) and starts[i] + len(tokens[i]) <= z:
            if not first or can_begin(tokens[i]):
                tags[i] = B if first else I
                first = False
            i += 1
    return tags


def stretches(tokens: list[str], tags: list[int]) -> Iterator[tuple[int, int]]:
    """(begin, end) of stretches of a line of about ``STRETCH`` tokens; none begins inside a secret."""
    a = 0
    while a < len(tokens):
        z = min(a + STRETCH, len(tokens))
        while z < len(tokens) and tags[z] == I:
            z += 1
        yield a, z
        a = z


def lessons(text: str) -> list[tuple[int, int, int]]:
    """(line's start, begin, end) of the stretches that a text teaches, at most ``STRETCHES`` by the hash of their place."""
    out = []
    for at, line in lines_of(text):
        tokens, starts = tokenize(line)
        out += [(at, a, z) for a, z in stretches(tokens, labels(tokens, starts, base_spans(line)))]
    if len(out) > STRETCHES:
        out = sorted(sorted(out, key=lambda x: zlib.crc32(b"%d %d" % x[:2]))[:STRETCHES])
    return out


_UPPER, _LOWER, _FIGURES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALPHABETS = (_UPPER + _LOWER + _FIGURES, _UPPER + _FIGURES, _LOWER + _FIGURES, _UPPER + _LOWER + _FIGURES + "+/")
_NAMES = ("key", "auth", "bearer", "credential", "pwd", "passphrase", "private", "signature", "access", "login")


def other_secret(rng: random.Random) -> str:
    """A secret of a form that no base pattern asks for: any alphabet, a prefix, groups or padding."""
    letters = rng.choice(_ALPHABETS)
    body = "".join(rng.choices(letters, k=rng.randint(14, 72)))
    at = rng.randrange(len(body))
    body = body[:at] + rng.choice(_FIGURES) + body[at:]
    form = rng.randrange(6)
    if form == 0:
        return f"{rng.choice(_LOWER)}{rng.choice(_LOWER)}_{rng.choice(('live', 'test', 'prod'))}_{body}"
    if form == 1:
        n = rng.randint(4, 8)
        return "-".join(body[i:i + n] for i in range(0, len(body), n))
    return body + "=" * rng.randint(1, 2) if form == 2 else body


def harmless(rng: random.Random, words: list[str]) -> str:
    """A long token with digits that is none: dates, phone numbers, hyphenated words, paths, names with a number."""
    day = f"{rng.randint(1990, 2035)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    a, b, c = (rng.choice(words) for _ in range(3))
    n = rng.randint(1, 9999)
    forms = (f"{day}T{rng.randint(0, 23):02d}", f"{day}/{day}", f"+{rng.randint(1, 99)}-{rng.randint(100, 999)}-{rng.randint(100, 999)}-{n:04d}",
             f"{a}-{b}-{c}-{n}", f"{a}/{b}/{c}{n}", f"{a}_{b}_{n}", f"{a}{n}{b}{c}", f"/{a}/{n}/{b}/{c}", f"{a}={n}_{b}={n + 1}_")
    return rng.choice(forms)


def variations(line: str, tokens: list[str], starts: list[int], tags: list[int], a: int, z: int) -> list[tuple[list[str], list[int]]]:
    """Tokens and tags around each secret of a stretch, with other forms and names, and with harmless tokens in its place.

    The base patterns' own labels know secrets by their form and name alone; these lessons mask both.
    """
    out = []
    for at in (i for i in range(a, z) if tags[i] == B):
        rng = random.Random(zlib.crc32(line[starts[at]:starts[at] + 4096].encode("utf-8", "surrogatepass")))
        low, high = max(a, at - NEAR), min(z, at + NEAR)
        words = [t for t in tokens[low:high] if t.isalpha() and t.isascii() and len(t) < 16 and not ASSIGN_NAME.search(t)] or ["page"]
        for real in [True, False] * VARIATIONS:
            new, own = [], []
            for i in range(low, high):
                if tags[i] == B:
                    text = other_secret(rng) if real else harmless(rng, words)
                    got = [m.group() for m in _TOKEN.finditer(text)]
                    first = next((k for k, t in enumerate(got) if can_begin(t)), None)
                    new += got
                    own += [O if not real or first is None or k < first else B if k == first else I for k in range(len(got))]
                elif tags[i] == O:
                    # a name of another kind, or any word of the text, where a pattern's name stands
                    new.append(rng.choice(_NAMES if rng.random() < 0.5 else words) if ASSIGN_NAME.search(tokens[i]) else tokens[i])
                    own.append(O)
            out.append((new, own))
    return out


def learn(texts: list[str], epochs: int = EPOCHS, of_files: list[list[str]] | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """Weights (DIM, 3), transitions (3, 3) and the number of stretches, by stochastic gradient ascent with AdaGrad.

    ``of_files``: the features of the whole texts if ``texts`` holds only some of their lines. At most
    ``MAX_STRETCHES`` stretches are learned, drawn by hash of text and place; lines may have any length.
    """
    rows, drawn = [], [lessons(text) for text in texts]
    if sum(map(len, drawn)) > MAX_STRETCHES:
        own = [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts]
        best = sorted((zlib.crc32(b"%d %d %d" % (own[k], x[0], x[1])), k, x) for k, xs in enumerate(drawn) for x in xs)
        drawn = [[] for _ in texts]
        for _, k, x in sorted(best[:MAX_STRETCHES], key=lambda y: y[1:]):
            drawn[k].append(x)
    for k, text in enumerate(texts):
        of_file, last = of_files[k] if of_files else file_features(text), None
        for at, a, z in drawn[k]:
            if at != last:
                end = text.find("\n", at)
                line, last = text[at:end if end >= 0 else len(text)], at
                tokens, starts = tokenize(line)
                tags = labels(tokens, starts, base_spans(line))
                legal = allowed(tokens)
                legal[np.arange(len(tags)), tags] = True
            if B not in tags[a:z]:
                continue
            # A long token that no pattern labels may be a secret of another form: its tag is left open.
            unseen = np.array([t == O and can_begin(x) for t, x in zip(tags[a:z], tokens[a:z])], bool)
            rows.append(([np.array(token_features(tokens, i, of_file), np.int16) for i in range(a, z)], legal[a:z], np.array(tags[a:z]), unseen))
            for new, own in variations(line, tokens, starts, tags, a, z):
                legal_new = allowed(new)
                legal_new[np.arange(len(own)), own] = True
                rows.append(([np.array(token_features(new, i, of_file), np.int16) for i in range(len(new))], legal_new, np.array(own),
                             np.zeros(len(own), bool)))
    w, step = np.zeros((DIM, 3)), np.zeros((3, 3))
    gw, gs = np.full((DIM, 3), 1e-2), np.full((3, 3), 1e-2)
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            features, legal, tags, unseen = rows[k]
            p, pairs = marginals(_scores(features, legal, w), step)
            own = np.zeros_like(p)
            own[np.arange(len(tags)), tags] = 1
            if unseen.any():
                own, seen = marginals(_scores(features, np.where(unseen[:, None], legal, own > 0), w), step)
            else:
                seen = np.zeros((3, 3))
                np.add.at(seen, (tags[:-1], tags[1:]), 1)
            diff = own - p
            size = np.array([len(f) for f in features])
            at, g = np.concatenate([np.array(f) for f in features]), np.repeat(diff, size, axis=0)
            bins, inverse = np.unique(at, return_inverse=True)
            grad = np.zeros((len(bins), 3))
            np.add.at(grad, inverse, g)
            grad -= 1e-3 * w[bins]
            gw[bins] += grad ** 2
            w[bins] += RATE * grad / np.sqrt(gw[bins])
            gs += (seen - pairs) ** 2
            step += RATE * (seen - pairs) / np.sqrt(gs)
    return w, step, sum(map(len, drawn))


class Field:
    def __init__(self, w: np.ndarray, step: np.ndarray):
        self.w, self.step = w, step

    def spans(self, text: str) -> list[Span]:
        """Spans of the field in a whole text."""
        out, of_file = [], None
        for at, line in lines_of(text):
            of_file = of_file or file_features(text)
            tokens, starts = tokenize(line)
            tags = viterbi(_scores([token_features(tokens, i, of_file) for i in range(len(tokens))],
                                   allowed(tokens), self.w), self.step)
            begin = end = None
            for t, s, tag in [*zip(tokens, starts, tags), ("", 0, O)]:
                if tag != I and begin is not None:
                    out.append((FIELD, at + begin, at + end))
                    begin = None
                if tag == B:
                    begin = s
                if tag != O:
                    end = s + len(t)
        return out


def train(docs: DataFrame, max_training: int = MAX_TRAINING) -> Field | None:
    """The field, learned from about ``max_training`` documents; None if they hold no line to learn from."""
    n = docs.count()
    if not n:
        return None
    # By id and text, so rows without an id are drawn like others; a repeated row counts once.
    place = F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 20))
    sample = docs.filter(F.col("text").isNotNull()).filter(place < int(min(1.0, max_training / n) * (1 << 20))) \
        .filter(F.col("text").rlike("[0-9]")).select("doc_id", "text").distinct()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "text"], kind="stable")
        w, step, n = learn(pdf["text"].tolist(), of_files=[x.split(" ") for x in pdf["of_file"]])
        return pd.DataFrame({"n": [n], "w": [w.tobytes()], "step": [step.tobytes()]})

    # Only texts with a line to learn from are dealt to the shards, each a task of its own.
    some = sample.mapInArrow(_with_lines, "doc_id bigint, of_file string, text string") \
        .withColumn("shard", F.pmod(F.xxhash64("doc_id", "text", F.lit(9)), F.lit(SHARDS)).cast("int")).repartitionById(SHARDS, "shard")
    def shard(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [x for x in pdfs if len(x)]
        if rows:
            yield run(pd.concat(rows))

    parts = some.mapInPandas(shard, "n bigint, w binary, step binary").collect()         # SHARDS rows
    total = sum(r["n"] for r in parts)
    if not total:
        return None
    mean = lambda c: sum(np.frombuffer(r[c], float) * (r["n"] / total)
                         for r in sorted(parts, key=lambda r: (r["n"], r["w"])))
    return Field(mean("w").reshape(DIM, 3), mean("step").reshape(3, 3))


def _with_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of every text the lines it teaches, with the features of the whole text."""
    for b in batches:
        rows = []
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            drawn = {at for at, _, _ in lessons(t)}
            kept = [x for at, x in lines_of(t) if at in drawn]
            if kept:
                rows.append((d, " ".join(file_features(t)), "\n".join(kept)))
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))],
                              names=["doc_id", "of_file", "text"])


def all_spans(text: str, base: list[Span], field: Field | None) -> list[Span]:
    """Base spans and those of the field that lie inside none of them, by start, then kind."""
    if field is None:
        return base
    starts, reach = [a for _, a, _ in base], list(accumulate((z for _, _, z in base), max))
    more = [s for s in field.spans(text) if not (k := bisect_right(starts, s[1])) or reach[k - 1] < s[2]]
    order = (*KINDS, FIELD)
    return sorted([*base, *more], key=lambda s: (s[1], order.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


_OUT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_field bigint"


def scan(docs: DataFrame, field: Field | None) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, base_sha256, all spans, and how many the field added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                base = base_spans(t or "")
                spans = all_spans(t or "", base, field)
                kinds = [k for k, *_ in base]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                             len(spans) - len(base)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.record_batch([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))],
                                  names=[f.split(" ")[0] for f in _OUT.split(", ")])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, _OUT)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch covered by spans replaced by ``[SECRET]``."""
    out, at = [], 0
    for _, a, z in spans:
        if z <= at:
            continue
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, z)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None) -> DataFrame:
    """The documents with their secrets masked; other columns as they are, ``n_chars`` counted anew."""
    @F.arrow_udf(StringType())
    def run(text: pa.Array) -> pa.Array:
        return pa.array([None if t is None else masked(t, all_spans(t, base_spans(t), field)) for t in text.to_pylist()],
                        pa.string())

    out = docs.withColumn("text", run("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text"))
                             .cast(docs.schema["n_chars"].dataType))
    return out


def scanned(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def q_secrets(spark, sf_dir):
    docs = scanned(table(spark, sf_dir, "documents"))
    return scan(docs, train(docs))
