"""Stream records: decoding fixtures, landing, empty batches, stream dedupe."""

import base64
import json
import os

from tidemark.streaming import landing, records

FIELDS = ("event_id", "customer_id", "event_ts", "event_type")


def _b64(b: bytes) -> str:
    return base64.b64encode(b).decode()


def _fixture_records(spark):
    obj = {"event_id": "E1", "customer_id": "C1", "event_ts": "2025-01-01T00:00:00", "event_type": "purchase"}
    rows = [
        ("1", _b64(json.dumps(obj).encode())),
        ("2", _b64(json.dumps(obj).encode())),                       # repeat
        ("3", _b64(json.dumps({**obj, "event_id": "E3", "customer_id": ""}).encode())),
        ("4", _b64(b"{}")),
        ("5", _b64(b"{bad")),
        ("6", _b64(b"[1,2]")),
        ("7", _b64(b"5")),
        ("8", _b64(b"null")),
        ("9", _b64(b"")),
        ("10", "%%%"),
        ("11", _b64(b"\xff\xfe{")),
        ("12", None),
        ("13", _b64(json.dumps({**obj, "event_id": "E13", "nested": {"a": 1}, "customer_id": 7}).encode())),
    ]
    return spark.createDataFrame(rows, "sequence_number string, value string")


def test_decode_fixtures(spark):
    dec = records.decode_records(_fixture_records(spark), FIELDS)
    got = {r["_sequence_number"]: r[records.DEAD_LETTER_COL] for r in dec.collect()}
    assert got == {"1": None, "2": None, "3": None, "4": None, "5": "malformed_json",
                   "6": "malformed_json", "7": "malformed_json", "8": "malformed_json",
                   "9": "empty_payload", "10": "invalid_base64", "11": "invalid_utf8",
                   "12": "invalid_base64", "13": None}
    good = {r["_sequence_number"]: r for r in records.good_records(dec).collect()}
    assert good["13"]["customer_id"] == "7" and good["1"]["event_type"] == "purchase"


def test_encode_decode_roundtrip(spark):
    df = spark.createDataFrame([("E1", "C1", "2025-01-01 00:00:00", "view")],
                               "event_id string, customer_id string, event_ts string, event_type string")
    dec = records.decode_records(records.encode_records(df, "event_id"), FIELDS)
    r = records.good_records(dec).first()
    assert (r["event_id"], r["customer_id"], r["event_type"]) == ("E1", "C1", "view")


def test_land_stream_and_dedupe(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    _fixture_records(spark).coalesce(1).write.parquet(os.path.join(src, "part=1"))
    out = os.path.join(tmp_dir, "out")
    q = landing.land_stream(landing.read_records(spark, src), f"{out}/good", f"{out}/dead",
                            f"{out}/_ck", FIELDS, available_now=True)
    q.awaitTermination()
    good = spark.read.parquet(f"{out}/good")
    dead = spark.read.parquet(f"{out}/dead")
    assert good.count() == 5 and dead.count() == 8
    assert "_ingested_ts" in good.columns and "batch_id" in good.columns
    # rerun with no new files: nothing new is written
    q = landing.land_stream(landing.read_records(spark, src), f"{out}/good", f"{out}/dead",
                            f"{out}/_ck", FIELDS, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/good").count() == 5
    # staged rule on the stream: drop anonymous, repeats within the watermark
    stream = records.good_records(records.decode_records(landing.read_records(spark, src), FIELDS))
    clean = landing.stage_clickstream_stream(stream)
    q = (clean.writeStream.format("parquet").option("path", f"{out}/clean")
         .option("checkpointLocation", f"{out}/_ck2").trigger(availableNow=True).start())
    q.awaitTermination()
    ids = sorted(r["event_id"] for r in spark.read.parquet(f"{out}/clean").collect())
    assert ids == ["E1", "E13"]


def test_stream_matches_batch(spark, tmp_dir):
    from tidemark.plans.staged import stage_clickstream
    recs = _fixture_records(spark)
    src = os.path.join(tmp_dir, "src")
    recs.write.parquet(src)
    stream = records.good_records(records.decode_records(landing.read_records(spark, src), FIELDS))
    q = (landing.stage_clickstream_stream(stream).writeStream.format("parquet")
         .option("path", f"{tmp_dir}/s").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    batch = records.good_records(records.decode_records(recs, FIELDS))
    _, b = stage_clickstream(batch, order_by=("event_ts",), stamp=None)
    s = spark.read.parquet(f"{tmp_dir}/s")
    assert sorted(r["event_id"] for r in s.collect()) == sorted(r["event_id"] for r in b.collect())


def test_micro_batch_options():
    mb = landing.MicroBatch()
    assert mb.source_options("kafka") == {"maxOffsetsPerTrigger": "500"}
    assert mb.trigger() == {"processingTime": "30 seconds"}
    assert mb.trigger(True) == {"availableNow": True}


def test_empty_source_writes_nothing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "empty")
    spark.createDataFrame([], "sequence_number string, value string").write.parquet(src)
    q = landing.land_stream(landing.read_records(spark, src), f"{tmp_dir}/good", f"{tmp_dir}/dead",
                            f"{tmp_dir}/ck", FIELDS, available_now=True)
    q.awaitTermination()
    assert not os.path.exists(f"{tmp_dir}/good")


def test_ndjson_landing_and_progress(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    _fixture_records(spark).write.parquet(src)
    out = os.path.join(tmp_dir, "out")
    q = landing.land_stream(landing.read_records(spark, src), f"{out}/good", f"{out}/dead",
                            f"{out}/_ck", FIELDS, fmt="json", available_now=True, progress_path=f"{out}/progress")
    q.awaitTermination()
    lines = spark.read.text(f"{out}/good").collect()
    assert len(lines) == 5 and all(r[0].startswith("{") for r in lines)
    prog = landing.batch_progress(spark, q).collect()
    assert sum(r["num_input_rows"] for r in prog) == 13
    kept = landing.landing_progress(spark, f"{out}/progress").agg({"landed": "sum", "dead": "sum"}).first()
    assert (kept["sum(landed)"], kept["sum(dead)"]) == (5, 8)


def test_compact_timestamp(spark):
    import datetime as dt

    from tidemark.functions.scalar import compact_timestamp
    df = spark.createDataFrame([(dt.datetime(2025, 3, 4, 5, 6, 7),)], "t timestamp")
    assert df.select(compact_timestamp("t")).first()[0] == "20250304_050607"


def test_stream_dedupe_keeps_late_rows(spark, tmp_dir):
    import datetime as dt
    import time
    schema = "event_id string, event_ts timestamp"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 30))], schema).coalesce(1) \
        .write.parquet(f"{tmp_dir}/src/f1")
    time.sleep(1.1)
    spark.createDataFrame([("b", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2024, 1, 30))], schema) \
        .coalesce(1).write.parquet(f"{tmp_dir}/src/f2")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src/*")
    q = (landing.dedupe_stream(s).writeStream.format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{tmp_dir}/out").collect()) == ["a", "b"]


def test_stream_alarm_matches_batch(spark, tmp_dir):
    import datetime as dt
    import time

    from tidemark.config import AlarmSpec
    from tidemark.operators import metrics
    from tidemark.streaming.alarms import alarm_states, stream_alarm

    base = dt.datetime(2025, 1, 1)
    schema = "metric string, ts timestamp, value double"
    drops = [[("m", 0, 70.0), ("m", 1, 10.0), ("n", 2, 1.0), ("m", 6, 80.0)],
             [("m", 16, 90.0), ("m", 21, 95.0), ("n", 22, 99.0)],
             [("m", 33, 5.0), ("n", 37, 99.0), ("m", 41, 99.0)],
             [("m", 90, 1.0), ("n", 91, 1.0)]]
    for i, rows in enumerate(drops):
        spark.createDataFrame([(k, base + dt.timedelta(minutes=m), v) for k, m, v in rows], schema) \
            .coalesce(1).write.parquet(f"{tmp_dir}/src/f{i}")
        time.sleep(1.1)
    for j, spec in enumerate([AlarmSpec("a", "max", 300, 60.0, 2, ">", "notBreaching"),
                              AlarmSpec("b", "max", 300, 60.0, 2, ">", "breaching"),
                              AlarmSpec("c", "sum", 300, 50.0, 2, ">=", "missing")]):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src/*")
        q = stream_alarm(stream, spec, "1 minute", f"{tmp_dir}/out{j}", f"{tmp_dir}/ck{j}", available_now=True)
        q.awaitTermination()
        got = {(r["metric"], r["period_start"]): (r["stat_value"], r["state"])
               for r in alarm_states(spark, f"{tmp_dir}/out{j}", spec).collect() if r["stat_value"] is not None}
        batch = {(r["metric"], r["period_start"]): (r["stat_value"], r["state"])
                 for r in metrics.metric_alarm(spark.read.parquet(f"{tmp_dir}/src/*"), spec).collect()
                 if r["stat_value"] is not None}
        assert got, spec
        assert all(batch[k] == v for k, v in got.items()), (spec, got, batch)
        assert any(v[1] == "ALARM" for v in got.values()), spec


def test_a_batch_is_always_bounded():
    import pytest
    with pytest.raises(ValueError):
        landing.MicroBatch().source_options("parquet", 0)


def test_convergence_takes_several_micro_batches(spark, tmp_dir):
    """Repeats batches apart and both arrival paths: staging keeps one of each event."""
    from tidemark.plans.registry import STREAM_FILES
    from tidemark.sources import testdata as td
    from tidemark.plans import staged
    from tidemark.sources.files import union_sources
    sf = "/root/testdata/sf0.001"
    td.event_records(spark, sf).repartition(STREAM_FILES).write.parquet(f"{tmp_dir}/src")
    q = landing.land_stream(landing.read_records(spark, f"{tmp_dir}/src"), f"{tmp_dir}/good", f"{tmp_dir}/dead",
                            f"{tmp_dir}/ck", td.EVENT_FIELDS, available_now=True, progress_path=f"{tmp_dir}/progress")
    q.awaitTermination()
    assert landing.landing_progress(spark, f"{tmp_dir}/progress").count() >= 5
    raw = union_sources(td.batch_export(spark, sf), landing.read_landed(spark, f"{tmp_dir}/good").select(*td.EVENT_FIELDS))
    clean = staged.stage_clickstream(raw, types=td.CLICKSTREAM_TYPES, stamp=None)[1]
    want = td.table(spark, sf, "events").filter("event_type <> 'error'")
    assert clean.count() == want.count() == clean.select("event_id").distinct().count()


def test_late_rows_are_counted(spark, tmp_dir):
    import datetime as dt
    import time

    from tidemark.config import AlarmSpec
    from tidemark.streaming.alarms import late_rows, stream_alarm
    schema, base = "metric string, ts timestamp, value double", dt.datetime(2025, 1, 1)
    for i, minutes in enumerate([0, 60, 90, 1, 120]):
        spark.createDataFrame([("m", base + dt.timedelta(minutes=minutes), 1.0)], schema).coalesce(1) \
            .write.parquet(f"{tmp_dir}/src/f{i}")
        time.sleep(1.1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/src/*")
    q = stream_alarm(stream, AlarmSpec("a", "sum", 300, 0.0), "1 minute", f"{tmp_dir}/out", f"{tmp_dir}/ck",
                     available_now=True)
    q.awaitTermination()
    assert late_rows(q) == 1
