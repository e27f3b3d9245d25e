"""End-to-end run over domain-shaped fixtures: zones, gate, summary."""

import pytest

from tidemark.operators.dq import CheckSpec, DataQualityError
from tidemark.plans.medallion import MedallionConfig, read_published, run_medallion


def _raw(spark, dup_customer=False):
    customers = [("C1", "2025-01-01", "ZA", "true"), ("C2", "2025-02-01", "NA", "false"),
                 ("C3", "2025-03-01", "KE", "true")]
    if dup_customer:
        customers += [("C1", "2025-01-01", "ZA", "true")] * 3
    products = [("P1", "Books", "10.00"), ("P2", "Home", "25.50")]
    events = [("E1", "C1", "S1", "2025-05-01T10:00:00", "page_view", "P1", "mobile", "ads"),
              ("E2", "C1", "S1", "2025-05-01T10:01:00", "product_view", "P1", "mobile", "ads"),
              ("E3", "C1", "S1", "2025-05-01T10:02:00", "purchase", "P1", "mobile", "ads"),
              ("E3", "C1", "S1", "2025-05-01T10:02:00", "purchase", "P1", "mobile", "ads"),
              ("E4", "", "S2", "2025-05-01T11:00:00", "page_view", "P2", "desktop", "seo"),
              ("E5", "C2", "S3", "2025-05-02T09:00:00", "remove_from_cart", "P2", "tablet", "email")]
    txns = [("O1", "C1", "P1", "2025-05-01", "1", "10.00", "completed"),
            ("O1", "C1", "P1", "2025-05-01", "1", "10.00", "completed"),
            ("O2", "C1", "P2", "2025-05-03", "2", "51.00", "completed"),
            ("O3", "C2", "P2", "2025-05-04", "1", "0", "completed"),
            ("O4", "C3", "P9", "2025-05-05", "1", "5.00", "refunded")]
    return {
        "customers": spark.createDataFrame(customers, "customer_id string, signup_date string, country string, marketing_opt_in string"),
        "products": spark.createDataFrame(products, "product_id string, category string, price string"),
        "clickstream_events": spark.createDataFrame(events, "event_id string, customer_id string, session_id string, event_ts string, event_type string, product_id string, device_type string, traffic_source string"),
        "transactions": spark.createDataFrame(txns, "order_id string, customer_id string, product_id string, order_date string, quantity string, amount string, status string"),
    }


def test_end_to_end(spark, tmp_dir):
    res = run_medallion(spark, _raw(spark), MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00"))
    c = res.counts
    assert c["raw.clickstream_events"] == 6 and c["staged.clickstream_events"] == 4
    assert c["rejected.clickstream_events"] == 1
    assert c["staged.transactions"] == 3 and c["rejected.transactions"] == 1
    assert res.dq_results.count() == 7
    prof = {r["customer_id"]: r for r in res.curated["customer_360"].collect()}
    assert prof["C1"]["conversion_rate"] == 1.0 and prof["C1"]["total_spend"] == 61.0
    assert prof["C1"]["avg_order_value"] == 30.5 and prof["C2"]["country"] == "NA"
    assert prof["C3"]["page_view"] is None and prof["C3"]["total_orders"] == 0
    assert "_ingested_ts" not in res.curated["customer_360"].columns
    funnel = [tuple(r) for r in res.summary["funnel"].collect()]
    assert funnel[0] == (1, "page_view", 1) and funnel[3] == (4, "checkout_start", 0)
    top = [r["category"] for r in res.summary["top_categories"].collect()]
    assert top == ["Home", "Books"]
    assert res.summary["avg_conversion"].first()["avg_conversion_rate"] == 1.0
    staged_txn = spark.read.parquet(f"{tmp_dir}/staged/transactions")
    assert "status" in staged_txn.columns and staged_txn.filter("status = 'completed'").count() == 2


def test_gate_blocks_curated(spark, tmp_dir):
    with pytest.raises(DataQualityError):
        run_medallion(spark, _raw(spark, dup_customer=True),
                      MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00"))
    import os
    assert not os.path.exists(f"{tmp_dir}/curated")
    assert os.path.exists(f"{tmp_dir}/dq_results")


def test_cli_on_csv(spark, tmp_dir):
    import os

    from tidemark.plans.medallion import main
    raw = _raw(spark)
    raw_dir = os.path.join(tmp_dir, "in")
    os.makedirs(raw_dir)
    for name, df in raw.items():
        pdf = df.toPandas()
        pdf.to_csv(os.path.join(raw_dir, f"{name}.csv"), index=False)
    assert main(["--raw-dir", raw_dir, "--lake-dir", os.path.join(tmp_dir, "lake"),
                 "--as-of", "2025-06-01 00:00:00"]) == 0
    prof = read_published(spark, os.path.join(tmp_dir, "lake"))["customer_360"]
    assert prof.count() == 3


def test_failed_gate_leaves_published_curated_unchanged(spark, tmp_dir):
    conf = MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00")
    run_medallion(spark, _raw(spark), conf)
    before = sorted(tuple(r) for r in read_published(spark, tmp_dir)["customer_360"].collect())
    with pytest.raises(DataQualityError):
        run_medallion(spark, _raw(spark, dup_customer=True), conf)
    after = sorted(tuple(r) for r in read_published(spark, tmp_dir)["customer_360"].collect())
    assert before == after and len(after) == 3
    runs = spark.read.parquet(f"{tmp_dir}/dq_results").select("run_id").distinct().count()
    assert runs == 2


def test_incremental_runs_equal_full_run(spark, tmp_dir):
    import os

    raw = _raw(spark)
    click, txn = raw["clickstream_events"], raw["transactions"]
    drop1 = dict(raw, clickstream_events=click.filter("event_id IN ('E1', 'E2', 'E3')"),
                 transactions=txn.filter("order_id IN ('O1', 'O2')"))
    drop2 = dict(raw, clickstream_events=click.filter("event_id IN ('E3', 'E4', 'E5')"),
                 transactions=txn.filter("order_id IN ('O2', 'O3', 'O4')"))
    inc = os.path.join(tmp_dir, "inc")
    conf = MedallionConfig(lake_dir=inc, as_of="2025-06-01 00:00:00", mode="incremental")
    run_medallion(spark, drop1, conf)
    res = run_medallion(spark, drop2, conf)
    full = run_medallion(spark, raw, MedallionConfig(lake_dir=os.path.join(tmp_dir, "full"),
                                                     as_of="2025-06-01 00:00:00"))
    for name in ("customer_360", "category_performance", "funnel_dropoff", "event_type_counts"):
        a = sorted(tuple(r) for r in res.curated[name].collect())
        b = sorted(tuple(r) for r in full.curated[name].collect())
        assert a == b, name
    staged = spark.read.parquet(os.path.join(inc, "staged", "clickstream_events"))
    assert sorted(r["event_id"] for r in staged.collect()) == ["E1", "E2", "E3", "E5"]
    rejects = spark.read.parquet(os.path.join(inc, "staged", "_rejects", "transactions"))
    assert {(r["order_id"], r["_reject_reason"], r["_copies"]) for r in rejects.collect()} == {
        ("O3", "invalid_amount", 1), ("O1", "duplicate", 1), ("O2", "duplicate", 1)}


def _txn(spark, rows):
    return spark.createDataFrame(rows, "order_id string, customer_id string, product_id string, order_date string, "
                                       "quantity string, amount string, status string")


def _spend(res):
    return {r["customer_id"]: r["total_spend"] for r in res.curated["customer_360"].collect()}


def test_late_customers_get_their_orders(spark, tmp_dir):
    """An order waits for its customer; of two rows of a key the earlier arrival wins, even if released later."""
    raw = _raw(spark)
    conf = MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00", mode="incremental",
                           dq_suite=(CheckSpec("uniqueness", "customers", ("customer_id",)),))
    some = raw["customers"].filter("customer_id = 'C1'")
    first = _txn(spark, [("O1", "C2", "P1", "2025-05-01", "1", "7", "completed"),
                         ("O2", "C3", "P1", "2025-05-01", "1", "9", "completed"), ("O4", "C9", "P1", "2025-05-01", "1", "1", "completed")])
    res = run_medallion(spark, dict(raw, customers=some, transactions=first), conf)
    assert res.counts["staged.transactions"] == 0 and res.counts["rejected.transactions"] == 3 and _spend(res) == {"C1": 0.0}
    # O2 comes again, for a known customer and without a readable date; C2 arrives
    second = _txn(spark, [("O2", "C1", "P1", "n/a", "1", "100", "completed"), ("O3", "C1", "P1", "", "1", "3", "completed")])
    res = run_medallion(spark, dict(raw, customers=raw["customers"].filter("customer_id <> 'C3'"), transactions=second), conf)
    assert _spend(res) == {"C1": 103.0, "C2": 7.0}
    # C3 arrives: the first O2 counts, the second is superseded; O3 returns with another date
    third = _txn(spark, [("O3", "C1", "P1", "2025-05-09", "1", "50", "completed")])
    res = run_medallion(spark, dict(raw, transactions=third), conf)
    spent = _spend(res)
    assert spent == {"C1": 3.0, "C2": 7.0, "C3": 9.0} and res.counts["superseded.transactions"] == 1
    assert res.counts["duplicate.transactions"] == 1 and res.counts["rejected.transactions"] == 1
    again = run_medallion(spark, dict(raw, transactions=third), conf)          # a replay adds nothing
    assert _spend(again) == spent and again.counts["staged.transactions"] == 0


def test_failed_gate_is_followed_by_a_good_run_and_modes_mix(spark, tmp_dir):
    raw = _raw(spark)
    full = MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00")
    inc = MedallionConfig(lake_dir=tmp_dir, as_of="2025-06-01 00:00:00", mode="incremental")
    run_medallion(spark, raw, full)
    more = _txn(spark, [("O9", "C1", "P1", "2025-05-06", "1", "2", "completed")])
    with pytest.raises(DataQualityError):
        run_medallion(spark, dict(_raw(spark, dup_customer=True), transactions=more), inc)
    res = run_medallion(spark, dict(raw, transactions=more), inc)
    assert _spend(res)["C1"] == 63.0 and res.counts["staged.transactions"] == 1
    back = run_medallion(spark, raw, full)                                     # a full run is a new base
    assert _spend(back)["C1"] == 61.0
    assert _spend(run_medallion(spark, dict(raw, transactions=more), inc))["C1"] == 63.0


def test_cli_incremental_takes_new_files_only(spark, tmp_dir):
    import os

    from tidemark.plans.medallion import main
    raw, raw_dir, lake = _raw(spark), os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "lake")
    for name, df in raw.items():
        os.makedirs(os.path.join(raw_dir, f"{name}.csv"))
        df.toPandas().to_csv(os.path.join(raw_dir, f"{name}.csv", "a.csv"), index=False)
    args = ["--raw-dir", raw_dir, "--lake-dir", lake, "--as-of", "2025-06-01 00:00:00", "--mode", "incremental"]
    assert main(args) == 0
    _txn(spark, [("O9", "C1", "P1", "2025-05-06", "1", "2", "completed")]).toPandas() \
        .to_csv(os.path.join(raw_dir, "transactions.csv", "b.csv"), index=False)
    assert main(args) == 0
    runs = spark.read.parquet(os.path.join(lake, "raw", "transactions")).groupBy("_run").count().collect()
    assert {r["_run"]: r["count"] for r in runs} == {0: 5, 1: 1}
    prof = {r["customer_id"]: r["total_spend"] for r in read_published(spark, lake)["customer_360"].collect()}
    assert prof["C1"] == 63.0


def test_cli_catalog_source(spark, tmp_dir):
    from tidemark.plans.medallion import main
    spark.sql("CREATE DATABASE IF NOT EXISTS shop_raw LOCATION '" + tmp_dir + "/db'")
    try:
        for name, df in _raw(spark).items():
            df.write.mode("overwrite").option("path", f"{tmp_dir}/db/{name}").saveAsTable(f"shop_raw.{name}")
        assert main(["--catalog", "shop_raw", "--lake-dir", f"{tmp_dir}/lake", "--as-of", "2025-06-01 00:00:00"]) == 0
    finally:
        spark.sql("DROP DATABASE shop_raw CASCADE")
