"""The lake's log: arrivals, atomic publication, concurrent runs, maintained curated tables."""

import os

import pytest

from tests.test_medallion import _raw, _spend, _txn
from tidemark.operators.dq import CheckSpec
from tidemark.plans import incremental as inc
from tidemark.plans import lake as log
from tidemark.plans import maintained as kept
from tidemark.plans import medallion as med
from tidemark.plans.curated import build_curated
from tidemark.plans.medallion import CURATED, MedallionConfig, read_published, run_medallion, run_sources

AS_OF = "2025-06-01 00:00:00"


def conf(lake, mode="incremental", **kw):
    return MedallionConfig(lake_dir=lake, as_of=AS_OF, mode=mode, **kw)


def contents(tables):
    return {n: sorted((tuple(r) for r in df.collect()), key=str) for n, df in tables.items()}


def put(df, path, name):
    """One more CSV file below ``path``."""
    os.makedirs(path, exist_ok=True)
    df.toPandas().to_csv(os.path.join(path, name), index=False)


def arrive(spark, tmp, raw):
    for name, df in raw.items():
        put(df, f"{tmp}/in/{name}.csv", "a.csv")
    return {t: [log.Source(t, f"{tmp}/in/{t}.csv")] for t in raw}


def test_put_if_absent(spark, tmp_dir):
    path = f"{tmp_dir}/log/0000000001.json"
    assert log.put_if_absent(spark, path, "one") and not log.put_if_absent(spark, path, "two")
    assert open(path).read() == "one" and log.list_names(spark, f"{tmp_dir}/log") == ["0000000001.json"]
    assert log.list_names(spark, f"{tmp_dir}/nothing") == [] and log.latest(spark, tmp_dir).version == -1


def test_full_then_incremental_takes_no_file_twice(spark, tmp_dir):
    """Batch files, landed records and pending orders count once, whichever mode took them."""
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    raw["transactions"] = raw["transactions"].unionByName(
        _txn(spark, [("O7", "C9", "P1", "2025-05-01", "1", "4", "completed")]))
    sources = arrive(spark, tmp_dir, raw)
    landed = f"{tmp_dir}/landed"
    sources["clickstream_events"].append(log.Source("clickstream_events/landed", landed, "parquet", optional=True))
    only = (CheckSpec("uniqueness", "customers", ("customer_id",)),)
    first = run_sources(spark, sources, conf(lake, "full", dq_suite=only))
    assert first.counts["raw.transactions"] == 6 and first.counts["pending.transactions"] == 1
    published = contents(read_published(spark, lake))
    again = run_sources(spark, sources, conf(lake, dq_suite=only))
    assert again.counts["raw.transactions"] == again.counts["raw.clickstream_events"] == 0
    assert again.counts["pending.transactions"] == 1 and again.counts["duplicate.transactions"] == 0
    assert contents(again.curated) == published
    raw["clickstream_events"].filter("event_id IN ('E1', 'E5')").unionByName(
        raw["clickstream_events"].filter("event_id = 'E5'").selectExpr("'E6' AS event_id", *raw["clickstream_events"].columns[1:])) \
        .write.parquet(f"{landed}/batch_id=0")
    third = run_sources(spark, sources, conf(lake, dq_suite=only))
    assert third.counts["raw.clickstream_events"] == 3 and third.counts["staged.clickstream_events"] == 1
    assert third.counts["duplicate.clickstream_events"] == 2
    last = run_sources(spark, sources, conf(lake, dq_suite=only))
    assert last.counts["raw.clickstream_events"] == 0 and last.counts["pending.transactions"] == 1
    full = run_sources(spark, sources, conf(lake, "full", dq_suite=only))      # a new base: every file once more
    assert full.counts["raw.clickstream_events"] == 9 and contents(full.curated) == contents(last.curated)
    assert run_sources(spark, sources, conf(lake, dq_suite=only)).counts["raw.clickstream_events"] == 0


@pytest.mark.parametrize("where", ["commit", "publish"])
def test_crash_leaves_the_last_version_and_no_trace(spark, tmp_dir, monkeypatch, where):
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    sources = arrive(spark, tmp_dir, raw)
    run_sources(spark, sources, conf(lake, "full"))
    before = contents(read_published(spark, lake))
    put(_txn(spark, [("O9", "C1", "P2", "2025-05-06", "1", "2", "completed")]), f"{tmp_dir}/in/transactions.csv", "b.csv")
    with monkeypatch.context() as m:
        if where == "commit":
            m.setattr(log, "commit", lambda *a: (_ for _ in ()).throw(IOError("lost")))
        else:                                       # between two curated tables
            path = kept.bucket_path
            m.setattr(kept, "bucket_path", lambda lake, table, *a: (_ for _ in ()).throw(IOError("lost"))
                      if table == "curated/funnel_dropoff" else path(lake, table, *a))
        with pytest.raises(IOError):
            run_sources(spark, sources, conf(lake))
    assert contents(read_published(spark, lake)) == before and log.latest(spark, lake).version == 0
    res = run_sources(spark, sources, conf(lake))
    assert res.counts["raw.transactions"] == 1 and res.counts["staged.transactions"] == 1 and _spend(res)["C1"] == 63.0
    assert log.latest(spark, lake).version == 1 and set(read_published(spark, lake)) == set(CURATED)


def test_second_of_two_runs_at_once_fails(spark, tmp_dir, monkeypatch):
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    run_medallion(spark, raw, conf(lake, "full"))
    more = lambda i: dict(raw, transactions=_txn(spark, [(f"X{i}", "C1", "P1", "2025-05-06", "1", str(i), "completed")]))
    publish = med.publish

    def meanwhile(*a):
        monkeypatch.setattr(med, "publish", publish)
        run_medallion(spark, more(5), conf(lake))
        return publish(*a)

    monkeypatch.setattr(med, "publish", meanwhile)
    with pytest.raises(log.ConcurrentRunError):
        run_medallion(spark, more(7), conf(lake))
    spent = {r["customer_id"]: r["total_spend"] for r in read_published(spark, lake)["customer_360"].collect()}
    assert spent["C1"] == 66.0
    assert _spend(run_medallion(spark, more(7), conf(lake)))["C1"] == 73.0


def test_readers_keep_their_version(spark, tmp_dir):
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    run_medallion(spark, raw, conf(lake, "full"))
    open_tables = read_published(spark, lake)
    before = contents(open_tables)
    more = dict(raw, transactions=_txn(spark, [("O9", "C1", "P2", "2025-05-06", "1", "2", "completed")]))
    run_medallion(spark, more, conf(lake))
    assert contents(open_tables) == before == contents(read_published(spark, lake, 0))
    assert sorted(med.register_published(spark, lake, prefix="now_")) == sorted(f"now_{t}" for t in CURATED)
    assert spark.sql("SELECT total_spend FROM now_customer_360 WHERE customer_id = 'C1'").first()[0] == 63.0


def test_maintained_tables_equal_those_from_all_staged_rows(spark, tmp_dir):
    """Late customers, superseded rows, changed customers and products: after every run as computed from scratch."""
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    only = (CheckSpec("uniqueness", "customers", ("customer_id",)),)
    c = conf(lake, dq_suite=only, wait_for_customer=("transactions", "clickstream_events"), buckets=4)
    some = raw["customers"].filter("customer_id = 'C1'")
    late = _txn(spark, [("O2", "C1", "P1", "n/a", "1", "100", "completed"), ("O8", "C3", "P1", "", "1", "3", "completed")])
    prices = raw["products"].selectExpr("product_id", "CASE WHEN product_id = 'P1' THEN 'Toys' ELSE category END AS category", "price")
    old = raw["transactions"].withColumnsRenamed({}).selectExpr(
        "order_id", "CASE WHEN order_id = 'O2' THEN 'C2' ELSE customer_id END AS customer_id", *raw["transactions"].columns[2:])
    drops = [dict(raw, customers=some, transactions=old), dict(raw, customers=some, transactions=late), raw,
             dict(raw, customers=raw["customers"].selectExpr("customer_id", "signup_date",
                                                             "CASE customer_id WHEN 'C3' THEN 'XX' ELSE country END AS country",
                                                             "marketing_opt_in"), products=prices,
                  transactions=late.filter("false"), clickstream_events=raw["clickstream_events"].filter("false"))]
    superseded = 0
    for i, drop in enumerate(drops):
        res = run_medallion(spark, drop, c)
        superseded += res.counts["superseded.transactions"]
        v = log.latest(spark, lake)
        staged = {}
        for n, fact in med.facts(c, None).items():
            schema = spark.read.parquet(inc.run_path(inc.staged_path(lake, n), 0)).schema
            staged[n] = inc.read_staged(spark, lake, fact, schema, v.runs).drop(inc.RUN, inc.ARRIVED)
        dims = {n: spark.read.parquet(inc.run_path(f"{lake}/staged/{n}", v.run)) for n in ("customers", "products")}
        want = build_curated(dims["customers"], staged["clickstream_events"], staged["transactions"], dims["products"], c.funnel,
                             c.completed_value)
        for n in CURATED:
            assert res.curated[n].columns == want[n].columns
        assert contents(res.curated) == contents(want), i
    assert superseded == 1
    assert res.counts["rewritten.curated/customer_360"] == 1          # only the bucket of the changed customer


def test_a_run_reads_its_own_rows_and_touched_buckets(spark, tmp_dir):
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    only = (CheckSpec("uniqueness", "customers", ("customer_id",)),)
    run_medallion(spark, raw, conf(lake, "full", dq_suite=only, buckets=8))
    v = log.latest(spark, lake)
    c, fact = conf(lake, dq_suite=only), med.facts(conf(lake), None)["transactions"]
    more = dict(raw, transactions=_txn(spark, [("O9", "C1", "P2", "2025-05-06", "1", "2", "completed")]),
                clickstream_events=raw["clickstream_events"].filter("false"))
    res = run_medallion(spark, more, c)
    now = log.latest(spark, lake)
    moved = {b for b, r in now.tables["curated/customer_360"].items() if r != v.run}
    assert len(moved) == 1 == res.counts["rewritten.curated/customer_360"] and now.buckets == 8
    schema = spark.read.parquet(inc.run_path(inc.staged_path(lake, "transactions"), now.run)).schema
    rows = med._changes(spark, c, fact, schema, now.run, list(v.runs), 0, None)
    assert rows.inputFiles() and all(f"_run={now.run}/" in f for f in rows.inputFiles())
    state = kept.read_buckets(spark, lake, "state/customers", spark.read.parquet(f"{lake}/state/customers/_run={now.run}").schema,
                              v.tables["state/customers"], [int(b) for b in moved])
    assert {f.split("_bucket=")[1].split("/")[0] for f in state.inputFiles()} == moved


def test_changed_rules_rebuild_the_state(spark, tmp_dir):
    raw = _raw(spark)
    run_medallion(spark, raw, conf(tmp_dir, "full"))
    none = dict(raw, transactions=raw["transactions"].filter("false"), clickstream_events=raw["clickstream_events"].filter("false"))
    res = run_medallion(spark, none, conf(tmp_dir, completed_value="refunded"))
    assert _spend(res) == {"C1": 0.0, "C2": 0.0, "C3": 5.0}


def test_replaced_folders_go_and_kept_ones_stay(spark, tmp_dir):
    raw = _raw(spark)
    only = (CheckSpec("uniqueness", "customers", ("customer_id",)),)
    for i in range(4):
        more = dict(raw, transactions=_txn(spark, [(f"X{i}", "C1", "P2", "2025-05-06", "1", "2", "completed")]))
        run_medallion(spark, more, conf(tmp_dir, dq_suite=only, buckets=4))
    v = log.latest(spark, tmp_dir)
    held = {(r, b) for x in (v, log.read_version(spark, tmp_dir, v.version - 1)) for b, r in x.tables["curated/customer_360"].items()}
    on_disk = {(int(d.split("=")[1]), f.split("=")[1]) for d in os.listdir(f"{tmp_dir}/curated/customer_360") if "=" in d
               for f in os.listdir(f"{tmp_dir}/curated/customer_360/{d}") if "=" in f}
    assert on_disk == held


def test_catalog_tables_by_arrival(spark, tmp_dir):
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_arrivals LOCATION '{tmp_dir}/db'")
    try:
        for name, df in raw.items():
            df.write.mode("overwrite").option("path", f"{tmp_dir}/db/{name}").saveAsTable(f"shop_arrivals.{name}")
        args = ["--catalog", "shop_arrivals", "--lake-dir", lake, "--as-of", AS_OF, "--buckets", "2"]
        assert med.main(args) == 0
        _txn(spark, [("O9", "C1", "P2", "2025-05-06", "1", "2", "completed")]).write.mode("append").insertInto("shop_arrivals.transactions")
        assert med.main([*args, "--mode", "incremental"]) == 0
        runs = {r["_run"]: r["count"] for r in spark.read.parquet(f"{lake}/raw/transactions").groupBy("_run").count().collect()}
        assert runs == {0: 5, 1: 1}
        prof = {r["customer_id"]: r["total_spend"] for r in read_published(spark, lake)["customer_360"].collect()}
        assert prof["C1"] == 63.0
    finally:
        spark.sql("DROP DATABASE shop_arrivals CASCADE")


def test_marks_are_compared_only_with_the_runs_that_hold_superseded_rows(spark, tmp_dir):
    """Rows of other runs take no part in the join with the marks, and without marks there is no join."""
    fact = inc.Fact("t", ("k",), (), "status", lambda rows: rows)
    schema = "k string, v int, status string"
    def put(run, rows, marks):
        inc.write_run(spark.createDataFrame(rows, schema), inc.staged_path(tmp_dir, "t"), run, ["status"])
        inc.write_run(spark.createDataFrame(marks, "k string, _of int"), inc.reject_path(tmp_dir, "t", "superseded"), run)
    typed = spark.createDataFrame([], schema).schema
    read = lambda runs: inc.read_staged(spark, tmp_dir, fact, typed, runs)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    held = lambda df: sorted((r["k"], r["v"], r["_run"]) for r in df.collect())
    put(0, [("a", 1, "x"), ("b", 1, "x")], [])
    put(1, [("c", 2, "x"), ("c2", 2, "y")], [])
    assert "Join" not in plan(read([0, 1])) and len(held(read([0, 1]))) == 4
    put(2, [("c", 3, "x")], [("c", 1), ("a", 7)])               # run 7 is none of those read
    got = read([0, 1, 2])
    assert held(got) == [("a", 1, 0), ("b", 1, 0), ("c", 3, 2), ("c2", 2, 1)]
    assert "Join LeftAnti" in plan(got) and "Union" in plan(got)
    assert held(read([1])) == [("c", 2, 1), ("c2", 2, 1)]       # the mark came with run 2
