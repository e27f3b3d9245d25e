"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row keeps the
measurements and one bit per failed rule; a policy is a versioned set of rules,
so applying another version, or asking what a version would keep without one of
its rules, is arithmetic on the stored bits and never a second look at a text.

All rules compare integers, so any engine reproduces the bits exactly.

Defined results: a null or empty text has no words, all measurements 0 and
fails ``too_few_words``; repeated rows give repeated ledger rows; an empty table
gives an empty ledger; extra columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import table

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_upper")
# Rule name -> condition (SQL over the measurements) under which a document fails.
# The place in this table is the place of the bit: append only.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 30 * n_words",
    "shouting": "100 * n_upper > 50 * n_letters",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("too_few_words", "repeated_windows"))
WEB = Policy("web-1", tuple(RULES))
POLICIES = {p.version: p for p in (BASE, WEB)}


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of MEASURES."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()      # bytes.split: exactly the ASCII white space
    n = len(words)
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    letters = upper = 0
    for c in text.encode("ascii", "ignore").translate(_CASE).split(b" "):
        letters += len(c)
        upper += c.count(b"U")
    return (n, len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), _repeated(words), letters, upper)


_CASE = bytes(85 if 65 <= i <= 90 else 108 if 97 <= i <= 122 else 32 for i in range(256))


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    if len(ids) == n:
        return 0
    pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(times[which] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


@F.pandas_udf(StructType([StructField(c, LongType()) for c in MEASURES]))
def _measured(text: pd.Series) -> pd.DataFrame:
    rows = np.array([measure(t) for t in text], np.int64).reshape(len(text), len(MEASURES))
    return pd.DataFrame(rows, columns=list(MEASURES))


def _with_bits(rows: DataFrame) -> DataFrame:
    return rows.withColumn("failed", F.expr(" | ".join(
        f"CASE WHEN {cond} THEN {BIT[name]}L ELSE 0L END" for name, cond in RULES.items())))


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: one bit per rule that fails."""
    return _with_bits(docs.select("doc_id", _measured("text").alias("m")).select("doc_id", "m.*"))


def passes(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and the version that decided it."""
    return rows.withColumns({"kept": passes(policy), "policy": F.lit(policy.version)})


def ablations(rows: DataFrame, policies: list[Policy]) -> DataFrame:
    """Per policy and rule: documents, how many fail the rule, how many only that rule.

    ``n_only`` is what dropping the rule from the policy would give back. One
    aggregate without keys: each task sends one row of counters.
    """
    cells = [(p, r) for p in policies for r in p.rules]
    failed = F.col("failed")
    sums = [F.count(F.lit(1)).alias("n")]
    for i, (p, r) in enumerate(cells):
        own = failed.bitwiseAND(F.lit(p.mask))
        sums += [F.sum((own.bitwiseAND(F.lit(BIT[r])) != 0).cast("long")).alias(f"f{i}"),
                 F.sum((own == BIT[r]).cast("long")).alias(f"o{i}")]
    one = rows.agg(*sums)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"), F.col("n").alias("n_docs"),
                 F.coalesce(f"f{i}", F.lit(0)).alias("n_failed"), F.coalesce(f"o{i}", F.lit(0)).alias("n_only"))
        for i, (p, r) in enumerate(cells)])))


def keep(docs: DataFrame, policy: Policy = WEB) -> DataFrame:
    """The documents the policy keeps, in their own columns.

    The measurements are taken beside the document's columns in the same task,
    so rejecting needs no join and no shuffle; the input's columns travel in a
    struct, so none of their names can clash with a measurement.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")
    rows = docs.select(own, _measured("text").alias("m")).select("d", "m.*")
    return _with_bits(rows).filter(passes(policy)).select("d.*")


def q_quality(spark, sf_dir):
    return apply_policy(ledger(table(spark, sf_dir, "documents")), WEB).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(BASE.mask)) != 0).alias("base_failed"), "kept", "failed")


SQL_MEASURES = r"""
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {docs}),
s AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
p AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM s),
tri AS (SELECT rid, i, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c FROM p WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, c, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM tri WHERE c IS NOT NULL) WHERE k > 1),
hit AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, (VALUES (0), (1), (2)) AS v(k) GROUP BY rid),
m AS (SELECT s.rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words,
             length(regexp_replace(t, '[^A-Za-z]', '', 'g'))::BIGINT AS n_letters,
             length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
      FROM s LEFT JOIN hit USING (rid)),
f AS (SELECT *, {bits} AS failed FROM m)"""


def sql_ledger(docs: str = "documents") -> str:
    bits = " | ".join(f"CASE WHEN {cond} THEN {BIT[name]}::BIGINT ELSE 0::BIGINT END" for name, cond in RULES.items())
    return SQL_MEASURES.format(docs=docs, bits=bits)


SQL = f"""WITH {sql_ledger()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & {BASE.mask}) <> 0 AS base_failed, (failed & {WEB.mask}) = 0 AS kept, failed FROM f"""
