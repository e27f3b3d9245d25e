"""Adapter from the supplied TPC-H-like Parquet tables to the shop domain.

customers    ← customer   (c_custkey is the customer id)
clickstream  ← events     (user_id is the customer id, ts the event time)
products     ← part       (p_type is the category: six values)
transactions ← orders     (customer grain; o_orderstatus 'F' means completed)
order lines  ← lineitem ⋈ orders (product grain)

Every adapter is a projection or a join on the scans, so Catalyst prunes
columns down to the Parquet reader and pushes filters into it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FunnelSpec

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# The supplied event types, mapped onto the funnel: view, click, signup,
# checkout_start (absent from the data, so it proves the zero fill),
# purchase; "error" is outside the funnel. Conversion = purchase / click.
TESTDATA_FUNNEL = FunnelSpec(stages=("view", "click", "signup", "checkout_start", "purchase"),
                             numerator="purchase", denominator="click")
COMPLETED = "F"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "customer_id")


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_ts"),
        "event_type", "value", "props")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"), "p_name", "p_brand", "p_size")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-grain transactions."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def completed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-grain transactions of completed orders.

    A left-semi join: each line is kept when its order is completed, no order
    column is carried, and the order side is reduced to keys (Spark may add a
    runtime Bloom filter from it to the line scan).
    """
    done = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == COMPLETED) \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(done, "l_orderkey", "left_semi").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line-grain transactions with the order's customer, date and status."""
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"))
    return table(spark, sf_dir, "lineitem").join(o, "l_orderkey", "inner").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        "customer_id", F.col("l_partkey").alias("product_id"), "order_date",
        F.col("l_shipdate").alias("ship_date"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("amount"), "status")


# ---------------------------------------------------------------------------
# Raw-zone views: the supplied tables as they would land, every value as text.
# ---------------------------------------------------------------------------

CLICKSTREAM_TYPES = {"event_id": "bigint", "customer_id": "bigint",
                     "event_ts": "timestamp_ntz", "value": "double"}
TRANSACTION_TYPES = {"order_id": "bigint", "line_no": "int", "customer_id": "bigint",
                     "product_id": "bigint", "order_date": "timestamp_ntz",
                     "ship_date": "timestamp_ntz"}


def batch_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch export of events, as text. Error events are logged before a
    visitor is identified, so their customer id is empty (anonymous)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("user_id").cast("string"))
        .alias("customer_id"),
        F.col("ts").cast("string").alias("event_ts"),
        "event_type", F.col("value").cast("string").alias("value"), "props")


def raw_clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as they arrive in the raw zone, as text, through two paths.

    The batch export carries every event (anonymous error events included);
    the stream path delivers at least once, so purchase events arrive a
    second time. Staging must drop the anonymous rows and the repeats.
    """
    batch = batch_export(spark, sf_dir)
    return batch.unionByName(batch.filter(F.col("event_type") == "purchase"))


def raw_transactions(spark: SparkSession, sf_dir: str, wanted: Column | None = None) -> DataFrame:
    """Line-grain transactions as text (order key, line number, customer, product, ...).

    An order's columns become text once, before its lines are joined. ``wanted`` is a condition on
    the ``lineitem`` columns, which then also holds for the orders' keys.
    """
    text = lambda c, name: F.col(c).cast("string").alias(name)
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), text("o_custkey", "customer_id"),
        text("o_orderdate", "order_date"), text("o_orderstatus", "status"))
    lines = table(spark, sf_dir, "lineitem")
    lines = lines if wanted is None else lines.filter(wanted)
    return lines.join(o, "l_orderkey", "inner").select(
        text("l_orderkey", "order_id"), text("l_linenumber", "line_no"), "customer_id", text("l_partkey", "product_id"),
        "order_date", text("l_shipdate", "ship_date"), text("l_quantity", "quantity"), text("l_extendedprice", "amount"), "status")


EVENT_FIELDS = ("event_id", "customer_id", "event_ts", "event_type", "value", "props")


def _record(fields: Sequence[str] = EVENT_FIELDS):
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]))


def _stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("event_ts"),
        "event_type", "value", "props")


def event_records(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    """Events as stream records ``(sequence_number, value)`` and ``extra`` columns of them.

    ``value`` is the base64 of a JSON object with the event's fields as text.
    Two transport faults of the kind the consumer must survive: the legacy
    client that emits error events sends its JSON without base64 encoding
    (dead letter), and purchase events are delivered twice (at least once).
    """
    copies = F.when(F.col("event_type") == "purchase", 2).otherwise(1)
    value = F.when(F.col("event_type") == "error", _record()).otherwise(F.base64(F.encode(_record(), "UTF-8")))
    return _stream_events(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("sequence_number"), value.alias("value"), *extra,
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy")).drop("_copy")


def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with the time they arrive: every tenth three days after it happened; purchases once more,
    twelve hours later, of every fourth event two days later."""
    ev = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("event_ts"), "event_type")
    i, hours = F.col("event_id"), lambda n: F.expr(f"event_ts + INTERVAL {n} HOURS")
    first = ev.withColumn("arrival", F.when(i % 10 == 0, hours(72)).otherwise(F.col("event_ts")))
    again = ev.filter("event_type = 'purchase'").withColumn("arrival", F.when(i % 4 == 0, hours(48)).otherwise(hours(12)))
    return first.unionByName(again)


def faulty_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records with every kind of transport fault, by a rule on the event id.

    id mod 7: 1 is not base64, 2 is base64 of bytes that are not UTF-8, 3 is an empty payload, 4 a
    JSON array, 5 a cut object; others are good. Ids divisible by 11 have no value.
    """
    m = F.col("event_id") % 7
    b64 = lambda c: F.base64(F.encode(c, "UTF-8"))
    value = (F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string"))
             .when(m == 1, F.concat(F.lit("%%"), b64(_record())))
             .when(m == 2, F.base64(F.unhex(F.lit("FFFE7B"))))
             .when(m == 3, b64(F.lit("  ")))
             .when(m == 4, b64(F.lit("[1,2]")))
             .when(m == 5, b64(F.substring(_record(), 1, 10)))
             .otherwise(b64(_record())))
    return _stream_events(spark, sf_dir).select(F.col("event_id").cast("string").alias("sequence_number"),
                                                value.alias("value"))


def faulty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions as text, with faults by a rule on order and line number; no row is left out.

    The rules are in ``FAULTS``; each is SQL that Spark and DuckDB read alike. Orders
    divisible by 5 arrive twice.
    """
    raw = raw_transactions(spark, sf_dir).withColumns({
        "o": F.col("order_id").cast("bigint"), "n": F.col("line_no").cast("bigint")})
    faulty = raw.select(*[F.expr(FAULTS.get(c, c)).alias(c) for c in raw.columns if c not in ("o", "n")], "o")
    return faulty.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("o") % 5 == 0, 2).otherwise(1)))) \
        .drop("_copy", "o")


# o and n are the order and line number of a row; every other name is a text column.
FAULTS = {
    "order_id": "CASE WHEN o % 43 = 0 THEN 'x' || order_id WHEN o % 47 = 0 THEN NULL "
                "WHEN o % 3 = 0 THEN '0' || order_id ELSE order_id END",
    "quantity": "CASE WHEN (o + n) % 11 = 0 THEN 'abc' WHEN (o + n) % 13 = 0 THEN '-1' WHEN (o + n) % 17 = 0 THEN '0.5' "
                "WHEN (o + n) % 19 = 0 THEN '1.5' WHEN (o + n) % 53 = 0 THEN '99999999999' ELSE quantity END",
    "amount": "CASE WHEN (o + n) % 23 = 0 THEN 'NaN' WHEN (o + n) % 29 = 0 THEN '0' WHEN (o + n) % 59 = 0 THEN NULL "
              "ELSE amount END",
    "customer_id": "CASE WHEN o % 31 = 0 THEN '' WHEN o % 37 = 0 THEN '99999999' WHEN o % 41 = 0 THEN ' ' || customer_id || ' ' "
                   "WHEN o % 4 = 0 THEN '00' || customer_id ELSE customer_id END",
    "order_date": "CASE WHEN o % 7 = 0 THEN 'n/a' ELSE order_date END",
}


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders with faults for the checks: missing customers, unknown customers, repeated keys, missing prices."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.withColumns({
        "o_custkey": F.when(k % 10 == 0, F.lit(None).cast("bigint")).when(k % 10 == 1, -F.col("o_custkey"))
        .otherwise(F.col("o_custkey")),
        "o_totalprice": F.when(k % 15 == 2, F.lit(float("nan"))).otherwise(F.col("o_totalprice")),
        "o_orderkey": F.when(k % 9 == 0, F.lit(9).cast("bigint")).otherwise(k)})


def medallion_drops(spark: SparkSession, sf_dir: str) -> list[dict]:
    """The raw tables of ``medallion_raw`` as three drops and a replay of the second.

    Customers arrive late (a third with each drop), so orders wait for them. Order lines and
    events are dealt to drops by their key. First lines of the first drop return in the second
    with another customer, no readable date and twice the amount; purchases are
    delivered again one drop later. None of it may change the result of a full run.
    """
    raw = medallion_raw(spark, sf_dir)
    order, event, events = F.col("l_orderkey"), F.col("event_id").cast("bigint"), raw["clickstream_events"]
    again = raw_transactions(spark, sf_dir, (order % 3 == 0) & (F.col("l_linenumber") == 1)).withColumns({
        "customer_id": F.lit("3"), "order_date": F.lit("n/a"),
        "amount": (F.col("amount").cast("decimal(18,2)") * 2).cast("string")})
    drops = []
    for i in range(3):
        t = raw_transactions(spark, sf_dir, order % 3 == i)
        e = events.filter(event % 3 == i).unionByName(
            events.filter((event % 3 == (i + 2) % 3) & (F.col("event_type") == "purchase")) if i else events.filter(F.lit(False)))
        drops.append({**raw, "customers": raw["customers"].filter(F.col("customer_id") % 3 <= i),
                      "transactions": t.unionByName(again) if i == 1 else t, "clickstream_events": e})
    return [*drops, {**drops[1], "customers": raw["customers"]}]


def late_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The customers in two files: those whose id is not divisible by 3, and the rest."""
    late = F.col("customer_id") % 3 == 0
    c = customers(spark, sf_dir)
    return c.filter(~late), c.filter(late)


def line_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All order lines as text in two files: even orders; odd ones, and once more those divisible by 10."""
    order = F.col("l_orderkey")
    return raw_transactions(spark, sf_dir, order % 2 == 0), raw_transactions(spark, sf_dir, (order % 2 == 1) | (order % 10 == 0))


# ---------------------------------------------------------------------------
# The whole medallion run over the supplied tables.
# ---------------------------------------------------------------------------

MEDALLION_TYPES = {
    "customers": {"customer_id": "bigint", "c_nationkey": "int", "c_acctbal": "double"},
    "products": {"product_id": "bigint", "price": "double", "p_size": "int"},
    "clickstream_events": CLICKSTREAM_TYPES,
    "transactions": TRANSACTION_TYPES,
}


def medallion_raw(spark: SparkSession, sf_dir: str) -> dict:
    """The four raw tables of the shop domain, derived from the supplied ones."""
    return {"customers": customers(spark, sf_dir), "products": products(spark, sf_dir),
            "clickstream_events": raw_clickstream(spark, sf_dir),
            "transactions": raw_transactions(spark, sf_dir)}


def medallion_config(lake_dir: str, as_of: str = "2001-09-01 00:00:00", mode: str = "full"):
    from tidemark.operators.dq import CheckSpec
    from tidemark.plans.medallion import MedallionConfig

    suite = (
        CheckSpec("completeness", "transactions", ("customer_id", "product_id", "amount")),
        CheckSpec("uniqueness", "transactions", ("order_id", "line_no")),
        CheckSpec("referential_integrity", "transactions", ("customer_id",), "customers", "customer_id"),
        CheckSpec("freshness", "transactions", ("order_date",), options={"max_age_days": 3650}),
        CheckSpec("uniqueness", "customers", ("customer_id",)),
        CheckSpec("uniqueness", "clickstream_events", ("event_id",)),
        CheckSpec("referential_integrity", "clickstream_events", ("customer_id",), "customers",
                  "customer_id"),
    )
    return MedallionConfig(lake_dir=lake_dir, funnel=TESTDATA_FUNNEL, completed_value=COMPLETED,
                           transaction_key=("order_id", "line_no"),
                           transaction_order=("_ingested_ts", "ship_date"),
                           types=dict(MEDALLION_TYPES), as_of=as_of, mode=mode, dq_suite=suite,
                           # with drops, customers arrive late: orders and events wait for them
                           wait_for_customer=("clickstream_events", "transactions"))
