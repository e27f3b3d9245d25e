"""Curated outputs: edge cases V4–V9 and cross-table properties."""

from tidemark.operators.category import category_performance, top_categories
from tidemark.operators.funnel import event_type_counts, funnel_dropoff, stage_counts
from tidemark.operators.profile import average_conversion, customer_profile
from tidemark.operators.spend import completed

CUST = "customer_id string"
EV = "customer_id string, event_type string"
TXN = "order_id string, customer_id string, product_id string, amount double, status string"


def _profile(spark, cust, ev, txn):
    return {r["customer_id"]: r.asDict() for r in customer_profile(
        spark.createDataFrame(cust, CUST), spark.createDataFrame(ev, EV),
        spark.createDataFrame(txn, TXN)).collect()}


def test_off_funnel_only_gives_zero_row_and_missing_events_null(spark):
    p = _profile(spark, [("A",), ("B",), ("C",)],
                 [("A", "remove_from_cart"), ("C", "purchase")],
                 [("o1", "C", "p", 10.0, "completed")])
    assert [p["A"][s] for s in ("page_view", "product_view", "add_to_cart", "checkout_start",
                                "purchase")] == [0, 0, 0, 0, 0]
    assert p["B"]["page_view"] is None and p["B"]["conversion_rate"] == 0.0
    assert p["B"]["total_orders"] == 0 and p["B"]["total_spend"] == 0.0
    # purchases without views: rate 0 (not capped, not NULL)
    assert p["C"]["conversion_rate"] == 0.0 and p["C"]["total_spend"] == 10.0


def test_rate_not_capped(spark):
    p = _profile(spark, [("A",)], [("A", "product_view"), ("A", "purchase"), ("A", "purchase")], [])
    assert p["A"]["conversion_rate"] == 2.0


def test_half_up_average(spark):
    # 0.01 + 0.02 = 0.03 / 2 = 0.015 → 0.02 (half-up); 1.005 style ties exact in integers
    p = _profile(spark, [("A",), ("B",)], [],
                 [("o1", "A", "p", 0.01, "completed"), ("o2", "A", "p", 0.02, "completed"),
                  ("o3", "B", "p", 2.67, "completed"), ("o4", "B", "p", 2.68, "completed"),
                  ("o5", "B", "p", 9.99, "refunded")])
    assert p["A"]["avg_order_value"] == 0.02
    assert p["B"]["avg_order_value"] == 2.68 and p["B"]["total_orders"] == 2


def test_unknown_product_null_category(spark):
    txn = spark.createDataFrame([("o1", "A", "p1", 5.0, "completed"), ("o2", "A", "zz", 7.0, "completed"),
                                 ("o3", "A", "p1", 100.0, "cancelled")], TXN)
    prod = spark.createDataFrame([("p1", "Books")], "product_id string, category string")
    got = {r["category"]: (r["revenue"], r["orders"])
           for r in category_performance(completed(txn), prod).collect()}
    assert got == {"Books": (5.0, 1), None: (7.0, 1)}
    dropped = category_performance(completed(txn), prod, drop_null=True).collect()
    assert [r["category"] for r in dropped] == ["Books"]


def test_category_order_and_top(spark):
    txn = spark.createDataFrame([(f"o{i}", "A", f"p{i % 7}", float(i), "completed") for i in range(30)], TXN)
    prod = spark.createDataFrame([(f"p{i}", f"c{i}") for i in range(7)], "product_id string, category string")
    perf = category_performance(completed(txn), prod)
    revs = [r["revenue"] for r in perf.collect()]
    assert revs == sorted(revs, reverse=True)
    assert [r["category"] for r in top_categories(perf, 5).collect()] == \
        [r["category"] for r in perf.collect()][:5]


def test_funnel_dropoff_zero_fill_and_order(spark):
    ev = spark.createDataFrame([("A", "page_view"), ("A", "purchase"), ("B", "page_view"),
                                ("B", "remove_from_cart")], EV)
    rows = [tuple(r) for r in funnel_dropoff(ev).orderBy("stage_no").collect()]
    assert rows == [(1, "page_view", 2), (2, "product_view", 0), (3, "add_to_cart", 0),
                    (4, "checkout_start", 0), (5, "purchase", 1)]
    types = {r[0]: r[1] for r in event_type_counts(ev).collect()}
    assert types == {"page_view": 2, "purchase": 1, "remove_from_cart": 1}


def test_stage_counts_hot_key(spark):
    # one key holds most rows: counts stay exact
    ev = spark.createDataFrame([("HOT", "page_view")] * 500 + [("x", "purchase")], EV).repartition(8)
    got = {r["customer_id"]: r["page_view"] for r in stage_counts(ev).collect()}
    assert got == {"HOT": 500, "x": 0}


def test_average_conversion(spark):
    prof = spark.createDataFrame([(1, 0.5), (2, 0.25), (0, 0.0), (None, 0.0)],
                                 "product_view long, conversion_rate double")
    r = average_conversion(prof).first()
    assert r["customers_with_views"] == 2 and r["avg_conversion_rate"] == 0.375


def test_revenue_equals_spend_when_all_known(spark, ):
    txn = spark.createDataFrame([(f"o{i}", f"C{i % 4}", f"p{i % 3}", i * 1.25, "completed")
                                 for i in range(1, 25)], TXN)
    prod = spark.createDataFrame([(f"p{i}", f"c{i}") for i in range(3)], "product_id string, category string")
    cust = spark.createDataFrame([(f"C{i}",) for i in range(4)], CUST)
    ev = spark.createDataFrame([], EV)
    rev = sum(r["revenue"] for r in category_performance(completed(txn), prod).collect())
    spend = sum(r["total_spend"] for r in customer_profile(cust, ev, txn).collect())
    assert round(rev, 2) == round(spend, 2)


def test_stage_names_with_dots(spark):
    from tidemark.config import FunnelSpec
    spec = FunnelSpec(stages=("page.view", "buy"), numerator="buy", denominator="page.view")
    cust = spark.createDataFrame([("A",)], CUST)
    ev = spark.createDataFrame([("A", "page.view"), ("A", "page.view"), ("A", "buy")], EV)
    txn = spark.createDataFrame([], TXN)
    r = customer_profile(cust, ev, txn, spec).first()
    assert r["page.view"] == 2 and r["conversion_rate"] == 0.5
    assert average_conversion(customer_profile(cust, ev, txn, spec), spec).first()["avg_conversion_rate"] == 0.5
