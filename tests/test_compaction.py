"""Compaction of a lake's runs: the same rows in fewer runs, readers and later runs undisturbed."""

import os
from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.test_lake import conf, contents
from tests.test_medallion import _raw, _txn
from tidemark.operators.dq import CheckSpec
from tidemark.plans import compaction
from tidemark.plans import lake as log
from tidemark.plans.compaction import choose, compact, read_staged_zone
from tidemark.plans.medallion import read_published, run_medallion


@given(st.lists(st.integers(0, 10_000), max_size=120), st.integers(2, 9), st.integers(1, 500))
@settings(max_examples=300, deadline=None)
def test_choose_leaves_few_runs_of_a_tier(sizes, fan, unit):
    sizes = dict(enumerate(sizes))
    groups = choose(sizes, fan, unit)
    merged = [r for g in groups for r in g]
    assert len(merged) == len(set(merged)) and set(merged) <= set(sizes) and all(len(g) >= fan for g in groups)
    left = [sum(sizes[r] for r in g) for g in groups] + [b for r, b in sizes.items() if r not in merged]
    assert sum(left) == sum(sizes.values())
    assert choose(dict(enumerate(left)), fan, unit) == []


def test_choose_rewrites_a_row_once_per_tier():
    """A hundred tiny runs, one after another: few runs are left, and little is written again."""
    held, written = {}, 0
    for i in range(100):
        held[i] = 1
        for k, group in enumerate(choose(held, 4, 2)):
            size = sum(held.pop(r) for r in group)
            written += size
            held[1000 * (k + 1) + i] = size
        assert len(held) < 4 * 5
    assert sum(held.values()) == 100 and written <= 100 * 4
    with pytest.raises(ValueError):
        choose({}, 1)


def _files(lake, table):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(f"{lake}/staged/{table}") for f in names)


def test_same_rows_before_and_after(spark, tmp_dir, monkeypatch):
    """Late customers, a superseded row, a mark on a run that stays, an older reader, a replay."""
    raw, lake = _raw(spark), f"{tmp_dir}/lake"
    c = conf(lake, dq_suite=(CheckSpec("uniqueness", "customers", ("customer_id",)),),
             wait_for_customer=("transactions", "clickstream_events"), buckets=4)
    assert compact(spark, c).version == -1
    some = raw["customers"].filter("customer_id = 'C1'")
    old = raw["transactions"].selectExpr("order_id", "CASE WHEN order_id = 'O2' THEN 'C2' ELSE customer_id END AS customer_id",
                                         *raw["transactions"].columns[2:])
    late = _txn(spark, [("O2", "C1", "P1", "n/a", "1", "100", "completed"), ("O8", "C3", "P1", "", "1", "3", "completed")])
    drops = [dict(raw, customers=some, transactions=old), dict(raw, customers=some, transactions=late), raw,
             dict(raw, transactions=_txn(spark, [("O9", "C7", "P1", "2025-05-09", "1", "2", "completed")]))]
    marks = 0
    for i, drop in enumerate(drops):
        marks += run_medallion(spark, drop, c, files=[("transactions", f"f{i}", i, i)]).counts["superseded.transactions"]
    assert marks == 1
    first = log.latest(spark, lake)
    want, published = contents(read_staged_zone(spark, c)), contents(read_published(spark, lake))
    arrived = {tuple(r) for r in log.arrivals(spark, lake, first.runs).collect()}
    reader = read_staged_zone(spark, c, first)

    assert compact(spark, c, fan=4) == first                        # three may be merged, the last run stays
    with monkeypatch.context() as m:
        m.setattr(compaction, "choose", lambda *a: [[0, 2]])        # run 2 holds a mark on a row of run 1
        second = compact(spark, c)
    assert second.runs == (4, 1, 3) and second.version == 4
    assert contents(read_staged_zone(spark, c)) == contents(reader) == want
    third = compact(spark, c, fan=2)
    assert third.runs == (5, 3) and contents(read_staged_zone(spark, c)) == want
    assert contents(read_published(spark, lake)) == published
    assert {tuple(r) for r in log.arrivals(spark, lake, third.runs).collect()} == arrived

    # later runs find the keys, the pending order and the files of merged runs
    more = run_medallion(spark, dict(raw, customers=raw["customers"].unionByName(
        raw["customers"].filter("customer_id = 'C1'").selectExpr("'C7' AS customer_id", *raw["customers"].columns[1:]))), c)
    assert more.counts["pending.transactions"] == 0 and more.counts["staged.transactions"] == 1
    assert more.counts["duplicate.transactions"] == 4 and more.counts["staged.clickstream_events"] == 0
    rows = {r["order_id"]: r["customer_id"] for r in read_staged_zone(spark, c)["transactions"].collect()}
    assert rows == {"O1": "C1", "O2": "C2", "O4": "C3", "O8": "C3", "O9": "C7"}
    now = log.latest(spark, lake)
    compact(spark, c, fan=2)
    runs = {n for n in os.listdir(f"{lake}/staged/transactions") if n.startswith("_run=")}
    assert "_run=0" not in runs and "_run=2" not in runs            # no kept version names them
    assert _files(lake, "transactions") <= 12
    assert contents(read_staged_zone(spark, c, now)) == contents(read_staged_zone(spark, c))

    # a run that commits in between wins, and nothing of the compaction counts
    def meanwhile(*a):
        last = log.latest(spark, lake)
        log.commit(spark, lake, replace(last, version=last.version + 1))
        return [list(last.runs)]
    held = contents(read_staged_zone(spark, c))
    monkeypatch.setattr(compaction, "choose", meanwhile)
    with pytest.raises(log.ConcurrentRunError):
        compact(spark, c)
    assert contents(read_staged_zone(spark, c)) == held
