"""Key-set joins: membership, negated membership, membership flags.

A key set is always a DataFrame used in a join, never a collected list in
``isin``: it may be as large as the fact table. No broadcast hint is given
on data-sized inputs; Spark broadcasts a side only when its estimated (or,
under AQE, measured) size is under ``spark.sql.autoBroadcastJoinThreshold``,
which is the size check, and otherwise plans a shuffle join. NULL keys never
match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _on(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def _key_set(keys_df: DataFrame, keys: Sequence[str], key_cols: Sequence[str] | None):
    key_cols = list(key_cols or keys)
    return keys_df.select(*[F.col(k).alias(t) for k, t in zip(key_cols, keys)])


def semi_join(df: DataFrame, keys_df: DataFrame, on, key_cols=None) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys_df`` (EXISTS)."""
    on = _on(on)
    return df.join(_key_set(keys_df, on, key_cols), on, "left_semi")


def anti_join(df: DataFrame, keys_df: DataFrame, on, key_cols=None) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys_df`` (NOT EXISTS, NULL-safe side: a NULL key is kept)."""
    on = _on(on)
    return df.join(_key_set(keys_df, on, key_cols), on, "left_anti")


def new_keys(batch: DataFrame, staged: DataFrame, on) -> DataFrame:
    """Rows of ``batch`` whose key is not staged yet (incremental append).

    Every staged key counts, whatever its date or partition: a key may return with
    another date, or none. The history is read as its key columns only.
    """
    on = _on(on)
    return batch.join(staged.select(*on), on, "left_anti")
