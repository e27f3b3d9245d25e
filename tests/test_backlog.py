"""A backlog in few micro-batches: many batches of a record log at once, several files a batch."""

import os

import pytest

from tests.test_record_log import put
from tidemark.plans import registry
from tidemark.streaming import landing, record_log
from tidemark.streaming.record_log import COUNT, RecordLogReader


def numbered(reader):
    """Per micro-batch: the records of each batch by number."""
    at, out = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        got = {}
        for p in reader.partitions(at, end):
            for b in reader.read(p):
                for r in b.to_pylist():
                    got.setdefault(r["batch"], []).append(r["sequence_number"])
        out.append(got)
        at = end
    return out


def test_batches_are_cut_as_if_one_by_one(tmp_dir):
    put(tmp_dir, "a", range(25))
    put(tmp_dir, "b", range(100, 103))
    a, b = [str(i) for i in range(25)], ["100", "101", "102"]
    options = {"path": tmp_dir, "maxRecords": "10", "startingOffsets": "earliest", "maxWaitSeconds": "0"}
    want = {0: a[:10] + b, 1: a[10:20], 2: a[20:]}
    assert numbered(RecordLogReader({**options, "maxBatches": "100"})) == [want]
    assert numbered(RecordLogReader({**options, "maxBatches": "2"})) == [{0: want[0], 1: want[1]}, {2: want[2]}]


def test_only_full_batches_before_the_wait_is_over(tmp_dir, monkeypatch):
    now = [100.0]
    monkeypatch.setattr(record_log.time, "monotonic", lambda: now[0])
    put(tmp_dir, "a", range(25))
    r = RecordLogReader({"path": tmp_dir, "maxRecords": "10", "startingOffsets": "earliest", "maxWaitSeconds": "30", "maxBatches": "9"})
    assert numbered(r) == [{0: [str(i) for i in range(10)], 1: [str(i) for i in range(10, 20)]}]
    now[0] += 29
    assert r.latestOffset() == r.at
    now[0] += 2
    assert r.latestOffset()[COUNT] == 3
    with pytest.raises(ValueError):
        RecordLogReader({"path": tmp_dir, "maxBatches": "0"})


def test_few_micro_batches_land_many_batches(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/out"
    put(log, "a", range(1200))

    def run():
        stream = record_log.read_log(spark, log, max_wait=0, starting_offsets="earliest", max_batches=50)
        record_log.drain(landing.land_stream(stream, f"{out}/good", f"{out}/dead", f"{out}/_ck", ("x",), batch_col="batch",
                                             batch=landing.MicroBatch(seconds=0), progress_path=f"{out}/progress"))
        return {r["batch_id"]: r["landed"] + r["dead"] for r in landing.landing_progress(spark, f"{out}/progress").collect()}

    assert run() == {0: 500, 1: 500, 2: 200}
    assert len(os.listdir(f"{out}/progress")) == 1
    put(log, "a", range(1200, 1900))
    put(log, "b", [5000])
    assert run() == {0: 500, 1: 500, 2: 200, 3: 501, 4: 200}
    dead = spark.read.parquet(f"{out}/dead").select("_sequence_number", "batch_id").collect()
    assert sorted(int(r[0]) for r in dead) == [*range(1900), 5000]
    assert {r["batch_id"] for r in dead} == {0, 1, 2, 3, 4}


def test_a_batch_has_several_files_of_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(registry, "RECORDS_A_FILE", 20)
    sf = "/root/testdata/sf0.001"
    assert registry._files_a_batch(spark, sf) > 3
    r = registry.q_stream_landing_progress(spark, sf).first()
    events = spark.read.parquet(f"{sf}/events.parquet")
    bought = events.filter("event_type = 'purchase'").count()
    assert r["batches"] == 8 and r["landed"] + r["dead"] == events.count() + bought
