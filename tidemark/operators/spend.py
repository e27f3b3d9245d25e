"""Spend per customer over completed orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import COMPLETED_STATUS, MONEY_SCALE
from tidemark.functions.scalar import half_up_ratio


def completed(transactions: DataFrame, status_col: str = "status",
              completed_value: str = COMPLETED_STATUS) -> DataFrame:
    """Only completed orders (prunes ``status=`` partitions when laid out so)."""
    return transactions.filter(F.col(status_col) == F.lit(completed_value))


def spend_per_customer(transactions: DataFrame, key: str = "customer_id",
                       amount: str = "amount", order_id: str = "order_id",
                       status_col: str = "status",
                       completed_value: str = COMPLETED_STATUS) -> DataFrame:
    """(key, total_orders, total_spend, avg_order_value) over completed orders.

    Money is summed as decimal(18,2) and converted to double only at the end;
    the average is rounded half-up to cents exactly, in integers.
    """
    amt = F.col(amount).cast("decimal(18,2)")
    cents = (amt * F.lit(10 ** MONEY_SCALE)).cast("long")
    agg = completed(transactions, status_col, completed_value).groupBy(key).agg(
        F.count(order_id).alias("total_orders"),
        F.sum(amt).alias("_spend"),
        F.sum(cents).alias("_cents"),
        F.count(amt).alias("_n_amounts"),
    )
    return agg.select(
        key,
        "total_orders",
        F.col("_spend").cast("double").alias("total_spend"),
        (half_up_ratio("_cents", "_n_amounts", 0) / F.lit(float(10 ** MONEY_SCALE)))
        .alias("avg_order_value"),
    )
