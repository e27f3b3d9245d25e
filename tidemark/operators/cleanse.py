"""Tag-and-split validation: one reject reason per row, computed once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REJECT_COL = "_reject_reason"

Rule = tuple[str, Column]   # (reason, condition that holds for a VALID row)


def tag_rejects(df: DataFrame, rules: Sequence[Rule], col: str = REJECT_COL) -> DataFrame:
    """Add ``col``: the first rule a row fails (a NULL condition fails), else NULL."""
    if not rules:
        return df.withColumn(col, F.lit(None).cast("string"))
    expr = None
    for reason, ok in rules:
        failed = ~F.coalesce(ok, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    return df.withColumn(col, expr)


def valid_rows(tagged: DataFrame, col: str = REJECT_COL) -> DataFrame:
    return tagged.filter(F.col(col).isNull()).drop(col)


def rejected_rows(tagged: DataFrame, col: str = REJECT_COL) -> DataFrame:
    return tagged.filter(F.col(col).isNotNull())


def reject_summary(tagged: DataFrame, reasons: Sequence[str], key: Sequence[str] | None = None,
                   col: str = REJECT_COL) -> DataFrame:
    """(reject_reason, rejected_rows) for every reason, zero-filled, plus
    ``duplicate`` (valid rows beyond the first per ``key``) and ``clean``.

    One aggregation over the tagged rows; the distinct count of valid keys is
    the only distinct aggregate, so Spark plans it without row expansion.
    """
    r = F.col(col)
    aggs = [F.count_if(r == F.lit(x)).alias(f"_r{i}") for i, x in enumerate(reasons)]
    aggs.append(F.count_if(r.isNull()).alias("_valid"))
    if key:
        k = [F.when(r.isNull(), F.col(c)) for c in key]
        aggs.append(F.count_distinct(*k).alias("_distinct"))
    else:
        aggs.append(F.count_if(r.isNull()).alias("_distinct"))
    totals = tagged.agg(*aggs)
    cells = [c for i, x in enumerate(reasons) for c in (F.lit(x), F.col(f"_r{i}"))]
    cells += [F.lit("duplicate"), F.col("_valid") - F.col("_distinct"),
              F.lit("clean"), F.col("_distinct")]
    return totals.select(F.stack(F.lit(len(cells) // 2), *cells).alias("reject_reason", "rejected_rows")) \
        .select("reject_reason", F.col("rejected_rows").cast("long"))
