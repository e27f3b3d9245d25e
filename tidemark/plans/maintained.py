"""Curated tables kept up to date from what a run adds and takes back.

Beside the published tables a lake keeps *state*: per customer, product and event type the counts and
decimal sums that the curated tables are made of. They can be added and subtracted, so a run aggregates its own
rows (+1) and the rows it superseded (-1) and adds the result to the state; the staged history is not read.

Keyed tables are divided into a fixed number of buckets by a hash of the key. A run reads and
rewrites only buckets in which a key changed; the other buckets stay in the folder of the run that wrote
them, and a version of the lake names the folder of every bucket. Customers come as a whole
snapshot; a checksum per bucket tells which buckets of it differ from the run before.

A full run is the same with no state before it. Within a run each fact is aggregated before any
join, so a hot customer, product or type is one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import MONEY_SCALE, RATE_SCALE, FunnelSpec
from tidemark.functions.scalar import half_up_ratio, safe_ratio
from tidemark.plans.lake import list_names
from tidemark.session import delete_path, scratch_path

BUCKET = "_bucket"
MONEY = "decimal(38,2)"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def bucket_path(lake: str, table: str, run: int, bucket: int | str) -> str:
    return f"{lake}/{table}/_run={run}/{BUCKET}={bucket}"


def read_buckets(spark: SparkSession, lake: str, table: str, schema: T.StructType, held: dict[str, int],
                 wanted: Sequence[int] | None = None) -> DataFrame:
    """The rows of a table's buckets (all, or some), each from the folder that holds it."""
    paths = [bucket_path(lake, table, run, b) for b, run in held.items() if wanted is None or int(b) in wanted]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_buckets(df: DataFrame, lake: str, table: str, run: int, bucket: Column, wanted: Sequence[int]) -> dict[str, int]:
    """Write the rows as this run's folders of their buckets; the run for each bucket of ``wanted`` that has rows.

    Small buckets are written by one task together, a large one by several.
    """
    rows = df.withColumn(BUCKET, bucket).hint("rebalance", BUCKET)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(f"{lake}/{table}/_run={run}")
    have = {n.split("=", 1)[1] for n in list_names(df.sparkSession, f"{lake}/{table}/_run={run}") if n.startswith(f"{BUCKET}=")}
    return {str(b): run for b in wanted if str(b) in have}


def carried(before: dict[str, int], rewritten: Sequence[int], new: dict[str, int]) -> dict[str, int]:
    """Where the buckets are now: rewritten ones in this run's folder, or nowhere if they have no row left."""
    gone = {str(b) for b in rewritten}
    return {**{b: r for b, r in before.items() if b not in gone}, **new}


# ----- state: what can be added and subtracted --------------------------------------

@dataclass(frozen=True)
class State:
    """A keyed table of sums. ``rows`` gives (key, sums) of signed staged rows (column ``_sign``)."""

    name: str
    key: str
    sums: tuple[str, ...]


def _sum(value: Column | str) -> Column:
    return F.sum(F.col("_sign") * (F.col(value) if isinstance(value, str) else value))


def stage_column(i: int) -> str:
    return f"stage_{i}"


def customer_state(funnel: FunnelSpec) -> State:
    return State("state/customers", "customer_id",
                 (*[stage_column(i) for i in range(len(funnel.stages))], "events", "orders", "amounts", "spend"))


PRODUCTS = State("state/products", "product_id", ("orders", "revenue"))
TYPES = State("state/event_types", "event_type", ("events",))


def customer_changes(events: DataFrame, completed_txns: DataFrame, funnel: FunnelSpec, key_type: str) -> DataFrame:
    """Per customer: events of each stage and in all, completed orders, amounts and spend, signed."""
    key = F.col("customer_id").try_cast(key_type).alias("customer_id")
    t, one = F.col("event_type"), F.lit(1)
    click = events.groupBy(key).agg(
        *[_sum(F.when(t == s, one).otherwise(0)).cast("long").alias(stage_column(i)) for i, s in enumerate(funnel.stages)],
        _sum(one).cast("long").alias("events"))
    amount = F.col("amount").cast("decimal(18,2)")
    spend = completed_txns.groupBy(key).agg(
        _sum(F.when(F.col("order_id").isNotNull(), 1).otherwise(0)).cast("long").alias("orders"),
        _sum(F.when(amount.isNotNull(), 1).otherwise(0)).cast("long").alias("amounts"),
        _signed_money(amount).alias("spend"))
    return click.unionByName(spend, allowMissingColumns=True)


def _signed_money(amount: Column) -> Column:
    return F.sum(F.when(F.col("_sign") < 0, -amount).otherwise(amount)).cast(MONEY)


def product_changes(completed_txns: DataFrame) -> DataFrame:
    return completed_txns.groupBy(F.col("product_id")).agg(
        _sum(F.when(F.col("order_id").isNotNull(), 1).otherwise(0)).cast("long").alias("orders"),
        _signed_money(F.col("amount").cast("decimal(18,2)")).alias("revenue"))


def type_changes(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(_sum(F.lit(1)).cast("long").alias("events"))


def apply_changes(spark: SparkSession, lake: str, state: State, before: dict[str, int], changes: DataFrame, run: int,
                  buckets: int) -> tuple[dict[str, int], T.StructType, list[int]]:
    """Add changes to the buckets they fall into; where the buckets are, the schema, and which were rewritten."""
    schema = T.StructType([changes.schema[state.key], *[changes.schema[c] for c in state.sums]])
    work = scratch_path(spark, "changes")
    bucket = bucket_of(state.key, buckets)
    changes.select(state.key, *state.sums).write.parquet(work)
    new = spark.read.schema(schema).parquet(work)
    touched = sorted(r[0] for r in new.select(bucket).distinct().collect())              # at most one row per bucket
    old = read_buckets(spark, lake, state.name, schema, before, touched)
    merged = old.unionByName(new).groupBy(state.key).agg(*[F.sum(c).cast(schema[c].dataType).alias(c) for c in state.sums])
    # a key that has nothing left leaves the state
    some = None
    for c in state.sums:
        some = (F.coalesce(c, F.lit(0)) != 0) if some is None else some | (F.coalesce(c, F.lit(0)) != 0)
    written = write_buckets(merged.filter(some), lake, state.name, run, bucket, touched) if touched else {}
    delete_path(spark, work)
    return carried(before, touched, written), schema, touched


# ----- curated tables from state ----------------------------------------------------

def profile(customers: DataFrame, state: DataFrame, funnel: FunnelSpec) -> DataFrame:
    """customers ⟕ state: the customer profile, as ``customer_profile`` makes it from all staged rows."""
    seen = F.col("events") > 0
    cents = (F.col("spend") * F.lit(10 ** MONEY_SCALE)).cast("decimal(38,0)")
    average = half_up_ratio(cents, F.col("amounts"), 0) / F.lit(float(10 ** MONEY_SCALE))
    own = state.select(
        "customer_id", *[F.when(seen, F.col(stage_column(i))).alias(s) for i, s in enumerate(funnel.stages)],
        F.coalesce("orders", F.lit(0)).alias("total_orders"),
        F.when(F.col("amounts") > 0, F.col("spend").cast("double")).alias("total_spend"),
        F.when(F.col("amounts") > 0, average).alias("avg_order_value"))
    out = customers.join(own, "customer_id", "left").na.fill(0, subset=["total_orders", "total_spend", "avg_order_value"])
    return out.withColumn("conversion_rate", safe_ratio(F.col(f"`{funnel.numerator}`"), F.col(f"`{funnel.denominator}`"), RATE_SCALE))


def categories(state: DataFrame, products: DataFrame) -> DataFrame:
    """(category, revenue, orders) from one row per product."""
    dim = products.select(F.col("product_id"), "category")
    return state.join(dim, "product_id", "left").groupBy("category").agg(
        F.sum("revenue").cast("double").alias("revenue"), F.sum("orders").cast("long").alias("orders")) \
        .orderBy(F.desc("revenue"), F.asc_nulls_last("category"))


def dropoff(state: DataFrame, stages: Sequence[str]) -> DataFrame:
    """(stage_no, stage, event_count) in stage order, absent stages 0."""
    n = state.agg(*[F.coalesce(F.sum(F.when(F.col("event_type") == s, F.col("events"))), F.lit(0)).alias(f"_s{i}")
                    for i, s in enumerate(stages)])
    cells = [c for i, s in enumerate(stages) for c in (F.lit(i + 1), F.lit(s), F.col(f"_s{i}"))]
    return n.select(F.stack(F.lit(len(stages)), *cells).alias("stage_no", "stage", "event_count")) \
        .select(F.col("stage_no").cast("int"), "stage", F.col("event_count").cast("long"))


def checksums(rows: DataFrame, key: str, buckets: int) -> dict[str, str]:
    """Per bucket a sum of hashes of the rows, whatever their order."""
    h = F.xxhash64(*[F.col(c).cast("string") for c in sorted(rows.columns)], F.lit(1)).cast("decimal(38,0)")
    got = rows.groupBy(bucket_of(key, buckets).alias("b")).agg(F.sum(h).alias("h"), F.count(F.lit(1)).alias("n")).collect()
    return {str(r["b"]): f"{r['n']}:{r['h']}" for r in got}                              # at most one row per bucket
