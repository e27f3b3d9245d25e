"""Deterministic dedupe: keep the first row per key under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (),
                 method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the smallest by ``order_by`` then all other columns.

    ``aggregate`` (default): ``min(struct(order_by..., rest...))`` per key. The
    partial aggregate runs map-side, so a key holding a third of the rows is
    collapsed to one row per map task before the shuffle — no task ever
    receives a whole hot group. ``window``: ``row_number()`` over the key; it
    shuffles every row and puts a hot key into one task, kept for columns
    that have no ordering (maps). Both keep exactly the same rows; NULLs sort
    first.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_first(c) for c in order_by + rest])
        return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.`{c}`").alias(c)
                          for c in df.columns])
