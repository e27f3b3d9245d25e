"""Storage lifecycle tiers (R2) and storage cost per tier.

Works on an inventory: one row per dated unit of storage (a date partition
or a file) with its bytes. ``partition_inventory`` derives one from a table
(rows and estimated bytes per day); ``file_inventory`` reads real file
sizes and modification times from Spark's ``_metadata`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import LIFECYCLE_RULES, STORAGE_PRICE_GB_MONTH

GIB = 1024 ** 3

_WIDTH = {"bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4,
          "date": 4, "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1}


def storage_class(age_days, zone: str) -> Column:
    """Storage class of an object ``age_days`` old in ``zone`` (lifecycle rules)."""
    age = F.col(age_days) if isinstance(age_days, str) else age_days
    rules = sorted(LIFECYCLE_RULES[zone], reverse=True)
    expr = None
    for min_age, tier in rules:
        cond = age >= F.lit(min_age)
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr.otherwise(F.lit(rules[-1][1]))


def row_bytes(df: DataFrame) -> Column:
    """Estimated uncompressed bytes of a row: fixed widths, text by UTF-8 length."""
    parts = []
    for name, dtype in df.dtypes:
        c = F.col(name)
        if dtype in _WIDTH:
            parts.append(F.when(c.isNotNull(), F.lit(_WIDTH[dtype])).otherwise(F.lit(0)))
        elif dtype == "string":
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif dtype == "binary":
            parts.append(F.coalesce(F.length(c), F.lit(0)))
        elif dtype.startswith("decimal"):
            parts.append(F.when(c.isNotNull(), F.lit(16)).otherwise(F.lit(0)))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def partition_inventory(df: DataFrame, date_col: str, as_of, zone: str = "raw") -> DataFrame:
    """(partition_date, rows, bytes, age_days, storage_class) per day of ``date_col``."""
    as_of_date = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else F.to_date(as_of)
    inv = df.groupBy(F.to_date(F.col(date_col)).alias("partition_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df)).alias("bytes"))
    age = F.datediff(as_of_date, F.col("partition_date"))
    return inv.withColumn("age_days", age).withColumn("storage_class", storage_class("age_days", zone))


def file_inventory(df: DataFrame, as_of, zone: str = "raw") -> DataFrame:
    """(file_path, bytes, modified, age_days, storage_class) per file of a file-based table."""
    as_of_date = F.to_date(F.lit(as_of)) if not isinstance(as_of, Column) else F.to_date(as_of)
    files = df.select("_metadata.file_path", "_metadata.file_size",
                      "_metadata.file_modification_time") \
        .groupBy("file_path").agg(F.max("file_size").alias("bytes"),
                                  F.max("file_modification_time").alias("modified"))
    age = F.datediff(as_of_date, F.to_date("modified"))
    return files.withColumn("age_days", age).withColumn("storage_class", storage_class("age_days", zone))


def _price(tier: Column) -> Column:
    expr = None
    for name, price in STORAGE_PRICE_GB_MONTH.items():
        cond = tier == F.lit(name)
        expr = F.when(cond, F.lit(price)) if expr is None else expr.when(cond, F.lit(price))
    return expr


def tier_cost(inventory: DataFrame) -> DataFrame:
    """(storage_class, units, gb, monthly_cost, monthly_cost_untiered) per class.

    ``monthly_cost_untiered`` is what the same bytes cost if everything stayed
    in STANDARD (nothing expires without lifecycle rules).
    """
    per = inventory.groupBy("storage_class").agg(F.count(F.lit(1)).alias("units"),
                                                 F.sum("bytes").alias("bytes"))
    gb = F.col("bytes") / F.lit(float(GIB))
    return per.select(
        "storage_class", "units", gb.alias("gb"),
        (gb * _price(F.col("storage_class"))).alias("monthly_cost"),
        (gb * F.lit(STORAGE_PRICE_GB_MONTH["STANDARD"])).alias("monthly_cost_untiered"))
