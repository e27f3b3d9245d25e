"""Alarms without a grid: equal to the grid, in blocks, carried over batches, silent metrics."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import AlarmSpec
from tidemark.operators import metrics

BASE = dt.datetime(2025, 1, 1)
SCHEMA = "metric string, period_start timestamp, stat_value double"


def spec(missing, n=3):
    return AlarmSpec("a", "max", 60, 5.0, n, ">", missing)


def some(seed, metrics_=3, periods=60, share=0.6):
    rng = random.Random(seed)
    return [(f"m{m}", BASE + dt.timedelta(minutes=k), rng.choice([None, 1.0, 9.0, 9.0, 9.0]))
            for m in range(metrics_) for k in range(periods) if rng.random() < share]


def grid(spark, rows, s):
    got = metrics.evaluate_periods(spark.createDataFrame(rows, SCHEMA), s)
    return sorted((r["metric"], r["period_start"], r["stat_value"], r["breaching"], r["state"]) for r in got.collect())


def expanded(rows):
    return sorted(((r["metric"], r["period_start"] + dt.timedelta(minutes=i), r["stat_value"], r["breaching"], r["state"])
                   for r in rows for i in range(r["periods"])), key=lambda x: (x[0], x[1]))


def same(got, want):
    key = lambda x: (x[0], x[1])
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("missing", ["notBreaching", "breaching", "missing", "ignore"])
@pytest.mark.parametrize("block", [1 << 16, 7])
def test_equal_to_the_grid(spark, monkeypatch, missing, block):
    monkeypatch.setattr(metrics, "BLOCK", block)
    for seed, n in ((1, 1), (2, 3)):
        rows = some(seed)
        out, _ = metrics.alarm_intervals(spark.createDataFrame(rows, SCHEMA), spec(missing, n))
        same(expanded(out.collect()), grid(spark, rows, spec(missing, n)))


@pytest.mark.parametrize("missing", ["notBreaching", "breaching", "missing"])
def test_carried_over_batches(spark, monkeypatch, missing):
    """After every batch the states are those of all periods so far; no earlier period is read again."""
    monkeypatch.setattr(metrics, "BLOCK", 10)
    rows, s = some(5) + [("late", BASE + dt.timedelta(minutes=50), 9.0)], spec(missing)
    carry, got = None, []
    for lo, hi in ((0, 13), (13, 14), (14, 33), (33, 60)):
        batch = [r for r in rows if lo <= (r[1] - BASE).seconds // 60 < hi]
        out, ends = metrics.alarm_intervals(spark.createDataFrame(batch, SCHEMA), s, carry)
        got += expanded(out.collect())
        carry = spark.createDataFrame(ends.collect(), metrics.CARRY)
        same(got, grid(spark, [r for r in rows if (r[1] - BASE).seconds // 60 < hi], s))


def test_a_stray_timestamp_costs_a_row(spark):
    rows = some(7, 1) + [("m0", dt.datetime(1970, 1, 1), 9.0)]
    for missing, extra in (("notBreaching", 2), ("breaching", 3), ("missing", 1)):
        base = metrics.alarm_intervals(spark.createDataFrame(rows[:-1], SCHEMA), spec(missing))[0].count()
        out = metrics.alarm_intervals(spark.createDataFrame(rows, SCHEMA), spec(missing))[0]
        assert out.count() == base + extra
        assert missing == "missing" or out.agg(F.max("periods")).first()[0] > 20_000_000


def test_no_periods(spark):
    out, carry = metrics.alarm_intervals(spark.createDataFrame([], SCHEMA), spec("breaching"))
    assert out.collect() == [] and carry.collect() == []


def test_silent_metrics(spark):
    """A silent metric's state follows from its last row, as the grid has it with one more row at the end."""
    rows = some(9, 4)
    for missing in ("notBreaching", "breaching", "missing"):
        s = spec(missing)
        _, carry = metrics.alarm_intervals(spark.createDataFrame(rows, SCHEMA), s)
        for minutes in (60, 61, 75):
            got = {r["metric"]: (r["silent_periods"], r["state"])
                   for r in metrics.silent_states(carry, s, str(BASE + dt.timedelta(minutes=minutes))).collect()}
            for m in got:
                last = max(k for x, k, _ in rows if x == m)
                silent = minutes - 1 - int((last - BASE).total_seconds() // 60)
                # the grid's state just before a row in the period that is not over
                more = [*rows, (m, BASE + dt.timedelta(minutes=minutes), 1.0)] if missing != "missing" else rows
                states = {(x[0], x[1]): x[4] for x in grid(spark, more, s)}
                at = BASE + dt.timedelta(minutes=minutes - 1) if missing != "missing" else last
                assert got[m] == (silent, states[(m, at)]), (missing, minutes, m)


def test_kept_states_follow_the_stream(spark, tmp_dir):
    """States of a stream equal the batch rule over its closed periods; a replayed batch changes nothing."""
    from tidemark.plans.registry import _feed
    from tidemark.session import make_path
    from tidemark.streaming import alarms
    s = AlarmSpec("a", "max", 60, 5.0, 2, ">", "breaching")
    series = [(m, ts + dt.timedelta(seconds=1), v if v is not None else 0.0) for m, ts, v in some(11, 2)]
    make_path(spark, f"{tmp_dir}/src/arrived")
    for i, (lo, hi) in enumerate(((0, 20), (20, 45), (45, 60))):
        part = [r for r in series if lo <= (r[1] - BASE).seconds // 60 < hi]
        spark.createDataFrame(part, "metric string, ts timestamp, value double").write.parquet(f"{tmp_dir}/src/to-come/drop={i}")
    stream = spark.readStream.schema("metric string, ts timestamp, value double").parquet(f"{tmp_dir}/src/arrived/*")
    _feed(spark, alarms.kept_alarm(stream, s, "0 seconds", f"{tmp_dir}/out", f"{tmp_dir}/ck", every="0 seconds"), f"{tmp_dir}/src")
    end = max(r[1] for r in series).replace(second=0)
    closed = [(m, ts.replace(second=0), v) for m, ts, v in series if ts.replace(second=0) < end]
    got = expanded(alarms.kept_states(spark, f"{tmp_dir}/out").collect())
    same(got, grid(spark, closed, s))
    carried = alarms.latest_carry(spark, f"{tmp_dir}/out")
    assert {(r["metric"], r["state"]) for r in metrics.silent_states(carried, s, str(end + dt.timedelta(hours=1))).collect()} == {
        ("m0", "ALARM"), ("m1", "ALARM")}
    last = max(int(n.split("=")[1]) for n in __import__("os").listdir(f"{tmp_dir}/out/carry"))
    rows = spark.createDataFrame([("m0", end, 9.0)], SCHEMA)
    alarms.keep_batch(rows, last + 5, s, f"{tmp_dir}/out")
    once = sorted(map(tuple, alarms.kept_states(spark, f"{tmp_dir}/out").collect()), key=str)
    alarms.keep_batch(rows, last + 5, s, f"{tmp_dir}/out")
    assert once == sorted(map(tuple, alarms.kept_states(spark, f"{tmp_dir}/out").collect()), key=str)
