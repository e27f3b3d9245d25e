"""The record log source: admission by records or time, growing shards, restarts."""

import os

import pytest

from tidemark.streaming import landing, record_log
from tidemark.streaming.record_log import RecordLogReader, end_of_lines


def put(path, shard, lines, end="\n"):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{shard}", "a") as f:
        f.write("\n".join(f"{i}\tv{i}" for i in lines) + end)


def numbers(reader, start, end):
    return [r[0] for p in reader.partitions(start, end) for r in reader.read(p)]


def batches(reader):
    at, out = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        out.append(numbers(reader, at, end))
        at = end
    return out


@pytest.mark.parametrize("ahead", [7, 1 << 16])
def test_batches_by_records_in_order(tmp_dir, monkeypatch, ahead):
    monkeypatch.setattr(record_log, "READ_AHEAD", ahead)
    put(tmp_dir, "a", range(25))
    put(tmp_dir, "b", range(100, 103))
    got = batches(RecordLogReader({"path": tmp_dir, "maxRecords": "10", "startingOffsets": "earliest", "maxWaitSeconds": "0"}))
    a, b = [str(i) for i in range(25)], ["100", "101", "102"]
    assert got == [a[:10] + b, a[10:20], a[20:]]
    assert end_of_lines(tmp_dir, "a", 0, 0, 5) == (0, 0)


def test_latest_skips_what_is_there_and_takes_new_shards_whole(tmp_dir):
    put(tmp_dir, "a", range(5))
    r = RecordLogReader({"path": tmp_dir, "maxWaitSeconds": "0"})
    at = r.initialOffset()
    assert r.latestOffset() == at
    put(tmp_dir, "a", [5, 6])
    put(tmp_dir, "b", [7])
    assert numbers(r, at, r.latestOffset()) == ["5", "6", "7"]


def test_unfinished_line_waits(tmp_dir):
    put(tmp_dir, "a", [1, 2], end="")
    r = RecordLogReader({"path": tmp_dir, "startingOffsets": "earliest", "maxWaitSeconds": "0"})
    assert batches(r) == [["1"]]
    put(tmp_dir, "a", ["2b"])                              # "2\tv2" + "2b\tv2b"
    assert numbers(r, r.at, r.latestOffset()) == ["2"]


def test_few_records_wait_for_their_time(tmp_dir, monkeypatch):
    now = [100.0]
    monkeypatch.setattr(record_log.time, "monotonic", lambda: now[0])
    put(tmp_dir, "a", range(12))
    r = RecordLogReader({"path": tmp_dir, "maxRecords": "10", "startingOffsets": "earliest", "maxWaitSeconds": "30"})
    at = r.initialOffset()
    first = r.latestOffset()
    assert len(numbers(r, at, first)) == 10               # enough of them: at once
    assert r.latestOffset() == first                      # two left: held back
    now[0] += 29
    assert r.latestOffset() == first
    now[0] += 2
    assert numbers(r, first, r.latestOffset()) == ["10", "11"]
    put(tmp_dir, "a", [12])
    assert r.latestOffset() == r.at                       # its own time starts anew


def test_bad_options(tmp_dir):
    for bad in ({"maxRecords": "0"}, {"startingOffsets": "middle"}):
        with pytest.raises(ValueError):
            RecordLogReader({"path": tmp_dir, **bad})


def test_stream_is_bounded_and_goes_on_after_a_restart(spark, tmp_dir):
    log, out = f"{tmp_dir}/log", f"{tmp_dir}/out"
    put(log, "a", range(1200))

    def run():
        stream = record_log.read_log(spark, log, max_wait=0, starting_offsets="earliest")
        record_log.drain(landing.land_stream(stream, f"{out}/good", f"{out}/dead", f"{out}/_ck", ("x",),
                                             batch=landing.MicroBatch(seconds=0), progress_path=f"{out}/progress"))
        return {r["batch_id"]: r["landed"] + r["dead"] for r in landing.landing_progress(spark, f"{out}/progress").collect()}

    assert run() == {0: 500, 1: 500, 2: 200}
    put(log, "a", range(1200, 1900))
    put(log, "b", [5000])
    assert run() == {0: 500, 1: 500, 2: 200, 3: 501, 4: 200}
    dead = spark.read.parquet(f"{out}/dead").select("_sequence_number").collect()
    assert sorted(int(r[0]) for r in dead) == [*range(1900), 5000]
