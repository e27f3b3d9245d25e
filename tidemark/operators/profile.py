"""Customer profile: funnel counts + spend + conversion rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import COMPLETED_STATUS, DEFAULT_FUNNEL, RATE_SCALE, FunnelSpec
from tidemark.functions.scalar import half_up_ratio, safe_ratio
from tidemark.operators.funnel import stage_counts
from tidemark.operators.spend import spend_per_customer

SPEND_COLUMNS = ("total_orders", "total_spend", "avg_order_value")


def customer_profile(customers: DataFrame, clickstream: DataFrame, transactions: DataFrame,
                     funnel: FunnelSpec = DEFAULT_FUNNEL, key: str = "customer_id",
                     completed_value: str = COMPLETED_STATUS) -> DataFrame:
    """customers ⟕ stage counts ⟕ spend, zero-filled spend, conversion rate.

    Both right-hand sides are aggregated to one row per ``key`` before the
    joins, so the joins never fan out and never see a hot key; both
    aggregates are hash-partitioned on ``key`` already, so the sort-merge
    joins reuse that partitioning and only ``customers`` is exchanged.

    Stage counts stay NULL for customers without events; spend columns are 0
    for customers without completed orders. ``conversion_rate`` is
    numerator / denominator stage rounded half-up to 4 places, 0 when the
    denominator is 0 or NULL, not capped at 1.
    """
    counts = stage_counts(clickstream, funnel.stages, key=key)
    spend = spend_per_customer(transactions, key=key, completed_value=completed_value)
    prof = customers.join(counts, key, "left").join(spend, key, "left")
    prof = prof.na.fill(0, subset=list(SPEND_COLUMNS)) \
        .withColumn("total_orders", F.col("total_orders").cast("long"))
    return prof.withColumn(
        "conversion_rate",
        safe_ratio(F.col(f"`{funnel.numerator}`"), F.col(f"`{funnel.denominator}`"), RATE_SCALE))


def average_conversion(profile: DataFrame, funnel: FunnelSpec = DEFAULT_FUNNEL) -> DataFrame:
    """Mean of the (rounded) per-customer rates over customers with views > 0.

    One row: (customers_with_views, avg_conversion_rate). The mean of rates
    with 4 decimals is taken exactly in integers and rounded half-up to 8.
    """
    viewed = profile.filter(F.col(f"`{funnel.denominator}`") > 0)
    rate_units = (F.col("conversion_rate") * F.lit(10 ** RATE_SCALE)).cast("decimal(18,0)")
    agg = viewed.agg(F.count(F.lit(1)).alias("customers_with_views"),
                     F.sum(rate_units.cast("long")).alias("_units"))
    return agg.select(
        "customers_with_views",
        (half_up_ratio("_units", "customers_with_views", 4) / F.lit(float(10 ** RATE_SCALE)))
        .alias("avg_conversion_rate"))
