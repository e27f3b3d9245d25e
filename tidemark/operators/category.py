"""Revenue and orders per product category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_performance(completed_lines: DataFrame, products: DataFrame,
                         product_key: str = "product_id", amount: str = "amount",
                         order_id: str = "order_id", category: str = "category",
                         drop_null: bool = False) -> DataFrame:
    """(category, revenue, orders) over completed transaction lines, by revenue desc.

    Lines are first reduced to one row per product (partial + final hash
    aggregate), so the join with the product table sees at most one row per
    product instead of one per line. Products without a category, or lines
    whose product is unknown, form a NULL category group unless
    ``drop_null``. Revenue is summed in decimal(18,2).
    """
    amt = F.col(amount).cast("decimal(18,2)")
    per_product = completed_lines.groupBy(F.col(product_key).alias("_pk")).agg(
        F.sum(amt).alias("_rev"), F.count(order_id).alias("_orders"))
    dim = products.select(F.col(product_key).alias("_pk"), F.col(category).alias("category"))
    joined = per_product.join(dim, "_pk", "left")
    if drop_null:
        joined = joined.filter(F.col("category").isNotNull())
    out = joined.groupBy("category").agg(
        F.sum("_rev").cast("double").alias("revenue"),
        F.sum("_orders").cast("long").alias("orders"))
    return out.orderBy(F.desc("revenue"), F.asc_nulls_last("category"))


def top_categories(perf: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` categories with the highest revenue (the limit is the feature)."""
    return perf.orderBy(F.desc("revenue"), F.asc_nulls_last("category")).limit(n)
