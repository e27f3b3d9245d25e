"""Scans and sinks, drift (R1), incremental staging."""

import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import incremental
from tidemark.plans.staged import stage_clickstream
from tidemark.sources import files


def test_text_csv_keeps_na_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c.csv")
    with open(p, "w") as f:
        f.write("customer_id,country\nC1,NA\nC2,\nC3,null\n")
    df = files.read_text_csv(spark, p, ["customer_id", "country"])
    got = {r[0]: r[1] for r in df.collect()}
    assert got == {"C1": "NA", "C2": None, "C3": "null"}
    assert all(t == "string" for _, t in df.dtypes)


def test_write_counts_by_observation(spark, tmp_dir):
    df = spark.range(10).withColumn("status", F.when(F.col("id") < 8, "completed").otherwise("refunded"))
    n = files.write_table(df, f"{tmp_dir}/t", partition_by=["status"])
    assert n == 10
    back = spark.read.parquet(f"{tmp_dir}/t")
    assert back.filter("status = 'completed'").count() == 8
    assert files.ingest_raw(df, f"{tmp_dir}/raw") == 10
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    assert dict(raw.dtypes)["id"] == "string" and "_ingested_ts" in raw.columns


def test_drift_report_and_merge(spark, tmp_dir):
    a = spark.createDataFrame([(1, "x")], "id int, old string")
    b = spark.createDataFrame([(2, 5)], "id int, new int")
    rep = {r["column"]: r["change"] for r in files.schema_drift(spark, a.schema, b.schema).collect()}
    assert rep == {"new": "added", "old": "missing"}
    merged = files.merge_drifted(a, b).orderBy("id").collect()
    assert merged[0]["new"] is None and merged[1]["old"] is None
    a.write.parquet(f"{tmp_dir}/d/1")
    b.write.parquet(f"{tmp_dir}/d/2")
    assert set(files.read_merged(spark, [f"{tmp_dir}/d/1", f"{tmp_dir}/d/2"]).columns) == {"id", "old", "new"}


def test_union_sources(spark):
    a = spark.createDataFrame([("1", "x")], "event_id string, device string")
    b = spark.createDataFrame([("2", "s1")], "event_id string, _sequence_number string")
    u = files.union_sources(a, b)
    assert u.count() == 2 and set(u.columns) == {"event_id", "device", "_sequence_number"}


def test_register_zone(spark, tmp_dir):
    spark.range(3).write.parquet(f"{tmp_dir}/curated/t1")
    files.register_zone(spark, f"{tmp_dir}/curated", ["t1"], prefix="z_")
    assert spark.sql("SELECT count(*) FROM z_t1").first()[0] == 3


def test_incremental_old_key_once_new_key_added(spark, tmp_dir):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("event_id", "customer_id", "event_ts")])
    raw_dir, staged_dir, ck = f"{tmp_dir}/raw", f"{tmp_dir}/staged", f"{tmp_dir}/ck"

    def stage(b):
        return stage_clickstream(b, types={"event_ts": "timestamp"}, stamp=None)[1]

    first = spark.createDataFrame([("e1", "C1", "2025-01-01 10:00:00"), ("e2", "C1", "2025-01-02 10:00:00")],
                                  schema)
    first.write.parquet(f"{raw_dir}/drop=0")
    incremental.stage_incremental(spark, f"{raw_dir}/drop=*", schema, stage, staged_dir, ck,
                                  ["event_id"], "event_date", "event_ts")
    second = spark.createDataFrame([("e2", "C1", "2025-01-02 10:00:00"), ("e3", "C2", "2025-01-03 10:00:00")],
                                   schema)
    second.write.parquet(f"{raw_dir}/drop=1")
    incremental.stage_incremental(spark, f"{raw_dir}/drop=*", schema, stage, staged_dir, ck,
                                  ["event_id"], "event_date", "event_ts")
    # replay with no new files changes nothing
    incremental.stage_incremental(spark, f"{raw_dir}/drop=*", schema, stage, staged_dir, ck,
                                  ["event_id"], "event_date", "event_ts")
    ids = sorted(r["event_id"] for r in spark.read.parquet(staged_dir).collect())
    assert ids == ["e1", "e2", "e3"]


def test_csv_raw_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("C1", "2025-01-01", "NA"), ("C2", None, "ZA")],
                               "customer_id string, signup_date string, country string")
    assert files.ingest_raw(df, f"{tmp_dir}/raw_csv", fmt="csv") == 2
    back = files.read_text_csv(spark, f"{tmp_dir}/raw_csv",
                               ["customer_id", "signup_date", "country", "_ingested_ts"])
    got = {r["customer_id"]: (r["signup_date"], r["country"]) for r in back.collect()}
    assert got == {"C1": ("2025-01-01", "NA"), "C2": (None, "ZA")}



def test_cluster_conf_profile():
    from tidemark.session import cluster_conf
    c = cluster_conf(8000, 100.0)
    assert int(c["spark.sql.shuffle.partitions"]) == 400_000
    assert cluster_conf(8000, 100.0, max_partitions=50_000)["spark.sql.shuffle.partitions"] == "50000"
    assert cluster_conf(100, 0.001)["spark.sql.shuffle.partitions"] == "400"
    assert c["spark.sql.autoBroadcastJoinThreshold"] == str(64 * 1024 * 1024)


def test_read_table_prunes_columns(spark, tmp_dir):
    spark.range(5).withColumn("x", F.col("id") * 2).write.parquet(f"{tmp_dir}/t")
    df = files.read_table(spark, f"{tmp_dir}/t", columns=["x"])
    assert df.columns == ["x"] and sorted(r[0] for r in df.collect()) == [0, 2, 4, 6, 8]
    assert "ReadSchema: struct<x:bigint>" in df._sc._jvm.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")
    assert files.table_exists(spark, f"{tmp_dir}/t") and not files.table_exists(spark, f"{tmp_dir}/none")


def test_scratch_needs_a_shared_folder_off_local(monkeypatch):
    """Without spark.checkpoint.dir only a local master gets a private folder."""
    from types import SimpleNamespace

    from tidemark.session import checkpoint_root
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                               sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))
        with pytest.raises(RuntimeError):
            checkpoint_root(fake)


def test_incremental_ignores_dates_of_returning_keys(spark, tmp_dir):
    """A key that returns with another date, or without one, is staged once; a replayed drop adds nothing."""
    from tidemark.plans import incremental
    schema = "event_id string, event_ts timestamp"
    import datetime as dt
    drops = [[("a", dt.datetime(2024, 1, 1)), ("n", None)], [("a", dt.datetime(2024, 1, 2)), ("n", None), ("b", None)],
             [("a", None), (None, dt.datetime(2024, 1, 3))]]
    for i, rows in enumerate(drops):
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(f"{tmp_dir}/raw/drop={i}")
        incremental.stage_incremental(spark, f"{tmp_dir}/raw/drop=*", df.schema, lambda b: b.dropDuplicates(["event_id"]),
                                      f"{tmp_dir}/staged", f"{tmp_dir}/ck", ["event_id"], "_date", "event_ts")
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_dir}/staged").collect()) == ["a", "b", "n"]
