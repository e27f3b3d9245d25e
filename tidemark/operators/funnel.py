"""Funnel operators: per-customer stage counts, overall drop-off, type counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import FUNNEL_STAGES


def stage_counts(events: DataFrame, stages: Sequence[str] = FUNNEL_STAGES,
                 key: str = "customer_id", type_col: str = "event_type") -> DataFrame:
    """One row per ``key`` with one bigint column per stage (pivot count).

    Written as ``count_if`` per stage rather than ``pivot`` so that the value
    list needs no distinct pass, absent stages come out as 0, and the plan is
    a single hash aggregate with a map-side partial step: a key holding a
    third of all events still shuffles only one partial row per map task.
    A key with only off-funnel events gets a row of zeros.
    """
    t = F.col(type_col)
    return events.groupBy(key).agg(*[F.count_if(t == F.lit(s)).alias(s) for s in stages])


def funnel_dropoff(events: DataFrame, stages: Sequence[str] = FUNNEL_STAGES,
                   type_col: str = "event_type") -> DataFrame:
    """Overall events per stage, in stage order, zero-filled: (stage_no, stage, event_count).

    A single global aggregate (partial per partition, one tiny final row)
    followed by an unpivot: no join with a stage dimension and no shuffle of
    event rows.
    """
    t = F.col(type_col)
    totals = events.agg(*[F.count_if(t == F.lit(s)).alias(f"_s{i}") for i, s in enumerate(stages)])
    cells = [c for i, s in enumerate(stages) for c in (F.lit(i + 1), F.lit(s), F.col(f"_s{i}"))]
    return totals.select(F.stack(F.lit(len(stages)), *cells).alias("stage_no", "stage", "event_count")) \
        .select(F.col("stage_no").cast("int"), "stage", F.col("event_count").cast("long"))


def event_type_counts(events: DataFrame, type_col: str = "event_type") -> DataFrame:
    """Every event type seen, with its count: (event_type, event_count)."""
    return events.groupBy(F.col(type_col).alias("event_type")) \
        .agg(F.count(F.lit(1)).alias("event_count"))
