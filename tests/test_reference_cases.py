"""The reference's seven unit cases, run against the real operators."""

from pyspark.sql import functions as F

from tidemark.functions.scalar import safe_ratio
from tidemark.operators import dq
from tidemark.plans.staged import stage_transactions


def _one(df):
    return df.collect()[0].asDict()


def test_completeness_passes_when_full(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "a int")
    r = _one(dq.check_completeness(df, "t", ["a"], threshold=0.95))
    assert r["status"] == "PASS" and r["metric_value"] == 1.0


def test_uniqueness_detects_duplicates(spark):
    df = spark.createDataFrame([("O1",), ("O1",), ("O2",)], "order_id string")
    r = _one(dq.check_uniqueness(df, "t", "order_id", threshold=0.999))
    assert r["status"] == "FAIL" and r["metric_value"] == 0.6667
    assert r["detail"] == "2/3 unique values for order_id"


def test_referential_integrity_catches_orphan(spark):
    df = spark.createDataFrame([("C1",), ("C99",)], "customer_id string")
    keys = spark.createDataFrame([("C1",)], "customer_id string")
    r = _one(dq.check_referential_integrity(df, "t", "customer_id", keys, threshold=0.99))
    assert r["status"] == "FAIL" and r["metric_value"] == 0.5


def test_zero_amount_rejected(spark):
    raw = spark.createDataFrame([("o1", "0", "2", "C1"), ("o2", "150.00", "1", "C2")],
                                "order_id string, amount string, quantity string, customer_id string")
    _, clean = stage_transactions(raw, stamp=None)
    rows = clean.collect()
    assert len(rows) == 1 and rows[0]["order_id"] == "o2"


def test_anonymous_filtered(spark):
    from tidemark.plans.staged import stage_clickstream
    raw = spark.createDataFrame([("e1", ""), ("e2", "C1"), ("e3", None)],
                                "event_id string, customer_id string")
    _, clean = stage_clickstream(raw, order_by=(), stamp=None)
    assert [r["customer_id"] for r in clean.collect()] == ["C1"]


def test_conversion_rate(spark):
    df = spark.createDataFrame([(10, 100)], "purchase int, product_view int")
    assert df.select(safe_ratio("purchase", "product_view", 4).alias("r")).first()["r"] == 0.10


def test_conversion_rate_zero_views(spark):
    df = spark.createDataFrame([(0, 0)], "purchase int, product_view int")
    assert df.select(safe_ratio("purchase", "product_view", 4).alias("r")).first()["r"] == 0.0
    nul = spark.createDataFrame([(None, None)], "purchase int, product_view int")
    assert nul.select(safe_ratio(F.col("purchase"), F.col("product_view"), 4).alias("r")).first()["r"] == 0.0
