"""Staged → curated (C4–C6): the published outputs from the four staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.config import COMPLETED_STATUS, DEFAULT_FUNNEL, FunnelSpec
from tidemark.operators.category import category_performance
from tidemark.operators.funnel import event_type_counts, funnel_dropoff
from tidemark.operators.profile import customer_profile
from tidemark.operators.spend import completed

TECHNICAL = ("_ingested_ts", "_cleansed_ts", "_date")


def business_columns(df: DataFrame) -> DataFrame:
    """Drop the technical stamps; curated outputs carry business columns only."""
    return df.drop(*[c for c in TECHNICAL if c in df.columns])


def build_curated(customers: DataFrame, clickstream: DataFrame, transactions: DataFrame,
                  products: DataFrame, funnel: FunnelSpec = DEFAULT_FUNNEL,
                  completed_value: str = COMPLETED_STATUS) -> dict[str, DataFrame]:
    """customer_360, category_performance, funnel_dropoff and event_type_counts (lazy)."""
    cust, click, txn, prod = (business_columns(d) for d in (customers, clickstream, transactions,
                                                            products))
    return {
        "customer_360": customer_profile(cust, click, txn, funnel, completed_value=completed_value),
        "category_performance": category_performance(
            completed(txn, completed_value=completed_value), prod),
        "funnel_dropoff": funnel_dropoff(click, funnel.stages),
        "event_type_counts": event_type_counts(click),
    }
