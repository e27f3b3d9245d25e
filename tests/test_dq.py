"""Data-quality edge cases."""

import datetime as dt

import pytest

from tidemark.operators import dq


def _one(df):
    return df.collect()[0].asDict()


def test_empty_table(spark):
    df = spark.createDataFrame([], "a string, d date")
    assert _one(dq.check_completeness(df, "t", ["a"]))["status"] == "FAIL"
    assert _one(dq.check_uniqueness(df, "t", "a"))["metric_value"] == 0.0
    f = _one(dq.check_freshness(df, "t", "d", as_of="2025-01-01 00:00:00"))
    assert f["status"] == "FAIL" and f["metric_value"] is None and f["detail"] == "Table is empty"


def test_freshness_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 25),)], "d date")
    f = _one(dq.check_freshness(df, "t", "d", max_age_days=7, as_of="2025-01-01 00:00:00"))
    assert f["status"] == "PASS" and f["metric_value"] == 7.0
    assert f["detail"] == "Latest record is 7 days old (max allowed: 7)"
    g = _one(dq.check_freshness(df, "t", "d", max_age_days=6, as_of="2025-01-01 00:00:00"))
    assert g["status"] == "FAIL"
    nul = spark.createDataFrame([(None,), (None,)], "d date")
    n = _one(dq.check_freshness(nul, "t", "d", as_of="2025-01-01 00:00:00"))
    assert n["status"] == "FAIL" and n["metric_value"] is None
    txt = spark.createDataFrame([("2024-12-31 12:00:00",), ("junk",)], "d string")
    assert _one(dq.check_freshness(txt, "t", "d", as_of="2025-01-01 00:00:00"))["metric_value"] == 0.0


def test_null_keys(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "k string")
    r = _one(dq.check_uniqueness(df, "t", "k"))
    assert r["metric_value"] == 0.5
    parents = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    ri = _one(dq.check_referential_integrity(df, "t", "k", parents))
    assert ri["metric_value"] == 0.75 and ri["detail"] == "3/4 rows have a valid k reference"


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert _one(dq.check_completeness(df, "t", ["x"]))["metric_value"] == 0.5


def test_status_uses_unrounded_score(spark):
    # 9,989.6 / 10,000 style: 0.99896 prints 0.999 but fails 0.999
    from pyspark.sql import functions as F
    df = spark.range(100000).select(F.when(F.col("id") < 99896, F.col("id")).otherwise(0).alias("k"))
    r = _one(dq.check_uniqueness(df, "t", "k", threshold=0.999))
    assert r["metric_value"] == 0.999 and r["status"] == "FAIL"
    assert r["detail"] == "99,896/100,000 unique values for k"


def test_completeness_detail(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    r = _one(dq.check_completeness(df, "t", ["x", "y"]))
    assert r["detail"] == "1/2 rows complete across ['x', 'y']"


def test_suite_and_gate(spark):
    good = spark.createDataFrame([("a",), ("b",)], "k string")
    bad = spark.createDataFrame([("a",), ("a",)], "k string")
    specs = [dq.CheckSpec("uniqueness", "good", ("k",)), dq.CheckSpec("uniqueness", "bad", ("k",))]
    results, failed = dq.run_suite_specs(specs, {"good": good, "bad": bad}, "2025-01-01 00:00:00")
    assert results.count() == 2 and failed.count() == 1
    assert dict(dq.suite_summary(results).first().asDict()) == {"checks": 2, "failed": 1}
    with pytest.raises(dq.DataQualityError):
        dq.gate(results)
    assert dq.gate(results.filter("status = 'PASS'")).count() == 1
    assert results.schema == dq.DQ_SCHEMA or [f.name for f in results.schema] == \
        [f.name for f in dq.DQ_SCHEMA]


def test_results_sink_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("a",)], "k string")
    r = dq.check_uniqueness(df, "t", "k", as_of="2025-01-01 00:00:00")
    for run_id in ("r1", "r1", "r2"):                  # a retry replaces its own rows
        dq.write_results(r, f"{tmp_dir}/dq", run_id)
    assert sorted(x["run_id"] for x in spark.read.parquet(f"{tmp_dir}/dq").collect()) == ["r1", "r2"]
