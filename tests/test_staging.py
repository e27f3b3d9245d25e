"""Staging edge cases (V1–V3, V10–V13) and properties."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.scalar import coerce_amount, coerce_quantity
from tidemark.operators.cleanse import REJECT_COL, reject_summary
from tidemark.operators.dedupe import dedupe_first
from tidemark.plans.staged import TRANSACTION_REASONS, stage_clickstream, stage_transactions

TXN = "order_id string, customer_id string, quantity string, amount string, _ingested_ts timestamp"


def test_coercion_edge_values(spark):
    vals = ["abc", "", None, "NaN", "Infinity", " 3 ", "-1", "0", "1.5", "0.5", "99999999999"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = df.select("v", coerce_amount("v").alias("a"), coerce_quantity("v").alias("q")).collect()
    amounts = {r["v"]: r["a"] for r in out}
    qty = {r["v"]: r["q"] for r in out}
    assert amounts[" 3 "] == Decimal("3.00")
    for bad in ("abc", "", None, "NaN", "Infinity"):
        assert amounts[bad] is None
    assert qty["1.5"] == 1 and qty["0.5"] == 0 and qty["99999999999"] is None
    assert qty["NaN"] is None and qty["Infinity"] is None and qty[" 3 "] == 3


def test_transactions_rules_no_exception(spark):
    t0 = dt.datetime(2025, 1, 1)
    rows = [("o1", "C1", "1.5", " 3 ", t0), ("o2", "C1", "0.5", "10", t0),
            ("o3", "C1", "2", "NaN", t0), ("o4", "", "2", "10", t0),
            ("o5", "C9", "2", "10", t0), ("o6", "C1", "99999999999", "1", t0),
            ("o7", "C1", "abc", "1", t0), ("o8", "C1", "1", "-1", t0)]
    raw = spark.createDataFrame(rows, TXN)
    valid = spark.createDataFrame([("C1",)], "customer_id string")
    tagged, clean = stage_transactions(raw, valid_customers=valid, stamp=None)
    got = {r["order_id"]: r[REJECT_COL] for r in tagged.collect()}
    assert got == {"o1": None, "o2": "invalid_quantity", "o3": "invalid_amount",
                   "o4": "missing_customer", "o5": "unknown_customer",
                   "o6": "invalid_quantity", "o7": "invalid_quantity", "o8": "invalid_amount"}
    c = clean.collect()
    assert len(c) == 1 and c[0]["quantity"] == 1 and c[0]["amount"] == Decimal("3.00")


def test_unknown_customer_only_with_valid_set(spark):
    raw = spark.createDataFrame([("o1", "C9", "1", "5", dt.datetime(2025, 1, 1))], TXN)
    assert stage_transactions(raw, stamp=None)[1].count() == 1
    valid = spark.createDataFrame([("C1",), ("C1",)], "customer_id string")
    assert stage_transactions(raw, valid_customers=valid, stamp=None)[1].count() == 0


def test_earliest_ingest_wins_and_repeatable(spark):
    rows = [("o1", "C1", "1", "5", dt.datetime(2025, 1, 3)),
            ("o1", "C2", "1", "6", dt.datetime(2025, 1, 1)),
            ("o1", "C3", "1", "7", dt.datetime(2025, 1, 2))]
    raw = spark.createDataFrame(rows, TXN)
    for _ in range(2):
        _, clean = stage_transactions(raw.repartition(3), order_by=("_ingested_ts",), stamp=None)
        r = clean.collect()
        assert len(r) == 1 and r[0]["customer_id"] == "C2"


def test_dedupe_methods_agree(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 3, "a"), (1, 5, "z"), (2, None, "q"), (2, 1, "p")],
                               "k int, t int, v string")
    a = sorted(dedupe_first(df, ["k"], ["t"]).collect())
    w = sorted(dedupe_first(df, ["k"], ["t"], method="window").collect())
    assert a == w
    assert [tuple(r) for r in a] == [(1, 3, "a"), (2, None, "q")]


def test_clean_plus_rejected_equals_input_and_idempotent(spark):
    rows = [(f"e{i % 7}", "" if i % 5 == 0 else f"C{i % 3}", dt.datetime(2025, 1, 1, 0, i))
            for i in range(40)]
    raw = spark.createDataFrame(rows, "event_id string, customer_id string, event_ts timestamp")
    tagged, clean = stage_clickstream(raw, stamp=None)
    summ = {r["reject_reason"]: r["rejected_rows"]
            for r in reject_summary(tagged, ["missing_customer"], key=["event_id"]).collect()}
    assert summ["missing_customer"] + summ["duplicate"] + summ["clean"] == raw.count()
    assert summ["clean"] == clean.count()
    assert clean.groupBy("event_id").count().filter("count > 1").count() == 0
    _, again = stage_clickstream(clean, stamp=None)
    assert sorted(again.collect()) == sorted(clean.collect())


def test_text_na_kept(spark):
    from tidemark.plans.staged import stage_passthrough
    df = spark.createDataFrame([("C1", "NA")], "customer_id string, country string")
    assert stage_passthrough(df).first()["country"] == "NA"


def test_reject_summary_zero_fill(spark):
    df = spark.createDataFrame([("a",)], "order_id string").withColumn(REJECT_COL, F.lit(None).cast("string"))
    got = {r[0]: r[1] for r in reject_summary(df, TRANSACTION_REASONS, ["order_id"]).collect()}
    assert got["invalid_amount"] == 0 and got["clean"] == 1 and got["duplicate"] == 0


def test_keys_are_typed_before_they_are_compared(spark):
    """' 7 ' and '07' are customer 7; unreadable keys are rejected, not merged; nothing is lost."""
    rows = [("1", " 7 ", "1", "5"), ("2", "07", "1", "5"), ("3", "8", "1", "5"), ("x", "7", "1", "5"), ("y", "7", "1", "5"),
            ("1", "7", "1", "6"), (None, "7", "1", "5")]
    raw = spark.createDataFrame(rows, "order_id string, customer_id string, quantity string, amount string")
    known = spark.createDataFrame([("7",), ("7",)], "customer_id string")
    tagged, clean = stage_transactions(raw, known, types={"order_id": "bigint", "customer_id": "bigint"}, stamp=None)
    assert sorted((r["order_id"], r["customer_id"]) for r in clean.collect()) == [(1, 7), (2, 7)]
    got = {r[0]: r[1] for r in reject_summary(tagged, TRANSACTION_REASONS, ["order_id"]).collect()}
    assert got == {"invalid_key": 3, "invalid_quantity": 0, "invalid_amount": 0, "missing_customer": 0,
                   "unknown_customer": 1, "duplicate": 1, "clean": 2}
    assert [r["_raw"]["order_id"] for r in tagged.filter(f"{REJECT_COL} = 'invalid_key'").collect()].count("x") == 1


def test_known_customers_are_joined_before_typing(spark):
    """What the join with the known customers moves is the row as it arrived, once: no typed columns, no copy of it."""
    from tidemark.plans.staged import tag_transactions
    raw = spark.createDataFrame([("1", "01", "2", "3.50"), ("2", "7", "1", "1"), ("3", None, "1", "1")],
                                "order_id string, customer_id string, quantity string, amount string")
    known = spark.createDataFrame([("1",), ("1",)], "customer_id string")
    df = tag_transactions(raw, known, types={"order_id": "bigint", "customer_id": "bigint"})
    plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert any("AS _raw" in line for line in plan[:join]) and not any("AS _raw" in line for line in plan[join:])
    assert df.columns == [*raw.columns, "_raw", "_reject_reason"]
    got = {r["order_id"]: (r["customer_id"], r["_raw"]["customer_id"], r["_reject_reason"]) for r in df.collect()}
    assert got == {1: (1, "01", None), 2: (7, "7", "unknown_customer"), 3: (None, None, "missing_customer")}
