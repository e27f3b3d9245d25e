"""Named queries over the supplied tables (the driver contract's ``queries()``).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame that reads whole tables; nothing
is collected. Most are lazy. The ``stream_*`` entries, ``incremental_ingest`` and the
``medallion_*`` entries run their streams or zones when called (that is what they show)
and return what was written. The matching DuckDB SQL lives in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ALARMS, AlarmSpec
from tidemark.functions.scalar import coerce_amount, coerce_quantity
from tidemark.operators import category as cat
from tidemark.operators import dq, joins, metrics, retention, spend
from tidemark.operators import funnel as fun
from tidemark.operators import profile as prof
from tidemark.operators.cleanse import reject_summary
from tidemark.operators.dedupe import dedupe_first
from tidemark.plans import incremental, lake, staged
from tidemark.plans.compaction import compact, read_staged_zone
from tidemark.plans.curated import build_curated
from tidemark.plans.medallion import run_medallion, run_sources
from tidemark.session import delete_path, make_path, move_path, scratch_path
from tidemark.sources import files
from tidemark.sources import testdata as td
from tidemark.streaming import alarms, landing, late, record_log, records

QueryFn = Callable[[SparkSession, str], DataFrame]


def q_customer_profile(spark, d):
    return prof.customer_profile(td.customers(spark, d), td.clickstream(spark, d),
                                 td.transactions(spark, d), funnel=td.TESTDATA_FUNNEL,
                                 completed_value=td.COMPLETED)


def q_customer_funnel(spark, d):
    return fun.stage_counts(td.clickstream(spark, d), td.TESTDATA_FUNNEL.stages)


def q_customer_spend(spark, d):
    return spend.spend_per_customer(td.transactions(spark, d), completed_value=td.COMPLETED)


def q_category_performance(spark, d):
    return cat.category_performance(td.completed_lines(spark, d), td.products(spark, d))


def q_top_categories(spark, d):
    return cat.top_categories(q_category_performance(spark, d), 5)


def q_funnel_dropoff(spark, d):
    return fun.funnel_dropoff(td.clickstream(spark, d), td.TESTDATA_FUNNEL.stages)


def q_event_type_counts(spark, d):
    return fun.event_type_counts(td.clickstream(spark, d))


def q_avg_conversion(spark, d):
    return prof.average_conversion(q_customer_profile(spark, d), td.TESTDATA_FUNNEL)


# ----- staging ------------------------------------------------------------

def q_coerce_numeric(spark, d):
    """Lenient parsing of numbers held as text: the ``k`` property of each event's
    JSON props and the event value rendered as text, as a quantity and an amount."""
    ev = td.table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    return ev.select("event_id", k.alias("k_text"), coerce_quantity(k).alias("k_quantity"),
                     coerce_amount(k).alias("k_amount"),
                     coerce_quantity(F.col("value").cast("string")).alias("value_quantity"),
                     coerce_amount(F.col("value").cast("string")).alias("value_amount"))


def _staged_clickstream(spark, d):
    return staged.stage_clickstream(td.raw_clickstream(spark, d), types=td.CLICKSTREAM_TYPES,
                                    stamp=None)


def q_stage_clickstream(spark, d):
    return _staged_clickstream(spark, d)[1]


def q_stage_clickstream_rejects(spark, d):
    tagged, _ = _staged_clickstream(spark, d)
    return reject_summary(tagged, staged.CLICKSTREAM_REASONS, key=["event_id"])


def _staged_transactions(spark, d):
    return staged.stage_transactions(
        td.raw_transactions(spark, d), valid_customers=td.customers(spark, d),
        key=("order_id", "line_no"), order_by=("ship_date",), types=td.TRANSACTION_TYPES,
        stamp=None)


def q_stage_transactions(spark, d):
    return _staged_transactions(spark, d)[1]


def q_stage_transactions_rejects(spark, d):
    tagged, _ = _staged_transactions(spark, d)
    return reject_summary(tagged, staged.TRANSACTION_REASONS, key=["order_id", "line_no"])


def q_dedupe_first(spark, d):
    return dedupe_first(td.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate"])


def q_semi_join_valid(spark, d):
    return joins.semi_join(td.table(spark, d, "orders"), td.table(spark, d, "customer"),
                           "o_custkey", key_cols=["c_custkey"])


def q_semi_join_known_keys(spark, d):
    """Orders of the customers that are known: those in the nations of even key, of all orders."""
    known = td.table(spark, d, "customer").filter(F.col("c_nationkey") % 2 == 0)
    return joins.semi_join(td.table(spark, d, "orders"), known, "o_custkey", key_cols=["c_custkey"])


def q_anti_join_new_keys(spark, d):
    """All orders whose key is not staged yet; staged are the orders that have a shipped line."""
    shipped = td.table(spark, d, "lineitem").filter(F.col("l_linestatus") == "F")
    return joins.new_keys(td.table(spark, d, "orders"), shipped.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


# ----- staging with faults ----------------------------------------------------

def _faulty_transactions(spark, d):
    return staged.stage_transactions(
        td.faulty_transactions(spark, d), valid_customers=td.customers(spark, d),
        key=("order_id", "line_no"), order_by=("ship_date",), types=td.TRANSACTION_TYPES, stamp=None)


def q_stage_faulty_transactions(spark, d):
    return _faulty_transactions(spark, d)[1]


def q_stage_faulty_transactions_rejects(spark, d):
    return reject_summary(_faulty_transactions(spark, d)[0], staged.TRANSACTION_REASONS, key=["order_id", "line_no"])


def q_category_performance_orphans(spark, d):
    """Category performance when every seventh product id is unknown: its lines form the NULL category."""
    lines = td.completed_lines(spark, d)
    p = F.col("product_id")
    return cat.category_performance(lines.withColumn("product_id", F.when(p % 7 == 0, -1 - p).otherwise(p)),
                                    td.products(spark, d))


# ----- data quality ---------------------------------------------------------

DQ_AS_OF = "2001-09-01 00:00:00"

# The standard seven checks, on the supplied tables: transactions ← orders,
# customers ← customer, clickstream ← events.
DQ_SUITE = (
    dq.CheckSpec("completeness", "orders", ("o_custkey", "o_totalprice", "o_orderdate")),
    dq.CheckSpec("uniqueness", "orders", ("o_orderkey",)),
    dq.CheckSpec("referential_integrity", "orders", ("o_custkey",), "customer", "c_custkey"),
    dq.CheckSpec("freshness", "orders", ("o_orderdate",), options={"max_age_days": 3650}),
    dq.CheckSpec("uniqueness", "customer", ("c_custkey",)),
    dq.CheckSpec("uniqueness", "events", ("event_id",)),
    dq.CheckSpec("referential_integrity", "events", ("user_id",), "customer", "c_custkey"),
)


def _dq_tables(spark, d):
    return {t: td.table(spark, d, t) for t in ("orders", "customer", "events", "lineitem")}


def q_dq_completeness(spark, d):
    return dq.run_check(DQ_SUITE[0], _dq_tables(spark, d), DQ_AS_OF)


def q_dq_uniqueness(spark, d):
    return dq.run_check(DQ_SUITE[1], _dq_tables(spark, d), DQ_AS_OF)


def q_dq_uniqueness_composite(spark, d):
    spec = dq.CheckSpec("uniqueness", "lineitem", ("l_orderkey", "l_linenumber"))
    return dq.run_check(spec, _dq_tables(spark, d), DQ_AS_OF)


def q_dq_referential_integrity(spark, d):
    return dq.run_check(DQ_SUITE[2], _dq_tables(spark, d), DQ_AS_OF)


def q_dq_freshness(spark, d):
    return dq.run_check(DQ_SUITE[3], _dq_tables(spark, d), DQ_AS_OF)


def q_dq_suite(spark, d):
    return dq.run_suite_specs(DQ_SUITE, _dq_tables(spark, d), DQ_AS_OF)[0]


FAULTY_SUITE = (
    dq.CheckSpec("completeness", "orders", ("o_custkey", "o_totalprice", "o_orderdate")),
    dq.CheckSpec("uniqueness", "orders", ("o_orderkey",)),
    dq.CheckSpec("referential_integrity", "orders", ("o_custkey",), "customer", "c_custkey"),
    dq.CheckSpec("freshness", "orders", ("o_orderdate",), options={"max_age_days": 30}),
    dq.CheckSpec("uniqueness", "customer", ("c_custkey",)),
)


def q_dq_suite_faulty(spark, d):
    """The suite on orders with faults: four checks fail, one passes."""
    return dq.run_suite_specs(FAULTY_SUITE, {**_dq_tables(spark, d), "orders": td.faulty_orders(spark, d)}, DQ_AS_OF)[0]


def q_dq_freshness_text(spark, d):
    """Freshness of a date held as text, every tenth unreadable."""
    k, date = F.col("o_orderkey"), F.col("o_orderdate").cast("string")
    text = td.table(spark, d, "orders").withColumn("o_orderdate", F.when(k % 10 == 0, "n/a").otherwise(date))
    return dq.run_check(DQ_SUITE[3], {"orders": text}, DQ_AS_OF)


def q_dq_results_retry(spark, d):
    """The suite's results written twice under one run id (a retry) and read back: each result once."""
    out = scratch_path(spark, "dq-results")
    for _ in range(2):
        dq.write_results(q_dq_suite(spark, d), out, "run-1")
    return spark.read.parquet(out).drop("run_id")


def q_dq_suite_summary(spark, d):
    return dq.suite_summary(q_dq_suite(spark, d))


# ----- stream records, landing, stream dedupe -------------------------------

def _typed_events(df):
    return staged.apply_types(df.select(*td.EVENT_FIELDS), td.CLICKSTREAM_TYPES)


def q_json_decode(spark, d):
    decoded = records.decode_records(td.event_records(spark, d), td.EVENT_FIELDS)
    return _typed_events(records.good_records(decoded))


def q_json_dead_letter(spark, d):
    decoded = records.decode_records(td.event_records(spark, d), td.EVENT_FIELDS)
    return records.dead_letters(decoded).select("_sequence_number", records.DEAD_LETTER_COL)


def q_json_decode_faulty(spark, d):
    decoded = records.decode_records(td.faulty_event_records(spark, d), td.EVENT_FIELDS)
    return _typed_events(records.good_records(decoded))


def q_json_dead_letter_faulty(spark, d):
    decoded = records.decode_records(td.faulty_event_records(spark, d), td.EVENT_FIELDS)
    return records.dead_letters(decoded).select("_sequence_number", records.DEAD_LETTER_COL)


STREAM_FILES = 8


RECORDS_A_FILE = 25_000           # at about 40,000 records a second and core, a file is less than a second's task


def _files_a_batch(spark, d):
    """Files of one of ``STREAM_FILES`` micro-batches: so many that each has about ``RECORDS_A_FILE`` records."""
    return max(1, -(-td.table(spark, d, "events").count() // (STREAM_FILES * RECORDS_A_FILE)))


def _record_source(spark, d):
    """The records as files of a stream; a delivery repeated at once is in the same file."""
    src = scratch_path(spark, "records")
    td.event_records(spark, d).repartition(STREAM_FILES * _files_a_batch(spark, d), "sequence_number").write.parquet(src)
    return src


def _drops(spark, rows, ts, path, drops=8):
    """Write ``rows`` in one pass as files of drops to come, each a stretch of the time ``ts``; rows without one come first.

    A drop has as many files as its rows need.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    first, last, n = rows.agg(F.min(at), F.max(at), F.count(F.lit(1))).first()
    step = -(-(last - first + 1) // drops) if first is not None else 1
    number = F.coalesce(F.floor((at - F.lit(first or 0)) / F.lit(step)).cast("int"), F.lit(-1))
    rows.withColumn("drop", number).repartitionByRange(max(drops, n // 1_000_000), "drop", ts) \
        .write.partitionBy("drop").parquet(f"{path}/to-come")


def _feed(spark, query, path):
    """Let the drops arrive one after the other while a query over ``path/arrived`` runs."""
    names = lake.list_names(spark, f"{path}/to-come")
    try:
        for name in sorted((n for n in names if n.startswith("drop=")), key=lambda n: int(n.split("=")[1])):
            move_path(spark, f"{path}/to-come/{name}", f"{path}/arrived/{name}")
            query.processAllAvailable()
    finally:
        query.stop()
    delete_path(spark, path)


def _landed(spark, src, out, files_a_batch):
    q = landing.land_stream(landing.read_records(spark, src, files_per_batch=files_a_batch), f"{out}/good", f"{out}/dead", f"{out}/_checkpoint",
                            td.EVENT_FIELDS, available_now=True, progress_path=f"{out}/progress")
    q.awaitTermination()
    delete_path(spark, src)
    return landing.read_landed(spark, f"{out}/good")


def q_stream_landing(spark, d):
    """Land the record backlog in bounded micro-batches and read the landed rows back."""
    return _typed_events(_landed(spark, _record_source(spark, d), scratch_path(spark, "landing"), _files_a_batch(spark, d)))


def q_stream_batch_convergence(spark, d):
    """Landed records and the batch export through the same staging rule: each event once.

    Records are dealt to micro-batches in turn, so repeats arrive batches apart; every event comes by both ways. The batch rule decides.
    """
    src, out = scratch_path(spark, "records"), scratch_path(spark, "convergence")
    n = _files_a_batch(spark, d)
    td.event_records(spark, d).repartition(STREAM_FILES * n).write.parquet(src)
    raw = files.union_sources(td.batch_export(spark, d), _landed(spark, src, out, n).select(*td.EVENT_FIELDS))
    return staged.stage_clickstream(raw, types=td.CLICKSTREAM_TYPES, stamp=None)[1]


def q_stream_landing_progress(spark, d):
    """What the landing's own records say: micro-batches, landed records and dead letters."""
    out = scratch_path(spark, "landing")
    _landed(spark, _record_source(spark, d), out, _files_a_batch(spark, d))
    return landing.landing_progress(spark, f"{out}/progress").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("landed").alias("landed"), F.sum("dead").alias("dead"))


STREAM_SHARDS = 16
BACKLOG_BATCHES = 128            # batches of a backlog that are landed in one micro-batch of Spark


def q_stream_landing_bounded(spark, d):
    """The landing of a record log, admitted by records: at most 500 of each shard in a batch, in order.

    The backlog is taken many batches at a time, and each batch is landed and counted as its own.
    """
    src, out = scratch_path(spark, "record-log"), scratch_path(spark, "landing-bounded")
    record_log.write_log(td.event_records(spark, d), src, STREAM_SHARDS)
    log = record_log.read_log(spark, src, max_wait=0, starting_offsets="earliest", max_batches=BACKLOG_BATCHES)
    record_log.drain(landing.land_stream(log, f"{out}/good", f"{out}/dead", f"{out}/_checkpoint", td.EVENT_FIELDS,
                                         batch=landing.MicroBatch(seconds=0), progress_path=f"{out}/progress", batch_col="batch"))
    delete_path(spark, src)
    return landing.landing_progress(spark, f"{out}/progress")


def q_stream_dedupe(spark, d):
    """Decode, drop anonymous rows and repeats on the stream, in bounded micro-batches; file sink; read back.

    The records come in time order, so none is later than the watermark.
    """
    src, out = scratch_path(spark, "records"), scratch_path(spark, "stream-dedupe")
    make_path(spark, f"{src}/arrived")
    _drops(spark, td.event_records(spark, d, F.col("event_ts").alias("at")), "at", src)
    stream = records.good_records(records.decode_records(
        landing.read_records(spark, f"{src}/arrived/*", files_per_batch=1_000), td.EVENT_FIELDS))
    clean = landing.stage_clickstream_stream(stream)
    _feed(spark, clean.writeStream.format("parquet").option("path", f"{out}/data")
          .option("checkpointLocation", f"{out}/_checkpoint").outputMode("append").start(), src)
    landed = spark.read.schema(clean.schema).parquet(f"{out}/data")
    return _typed_events(landed.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz")))


STREAM_DELAY_SECONDS = 24 * 3600


def q_stream_late_rows(spark, d):
    """Events that arrive out of order: per event, whether it was kept, how often repeated and how often late.

    Rows behind the watermark go to an output of their own, the others to a stream that keeps one of each
    event, so every row that arrived is accounted for.
    """
    src, out = scratch_path(spark, "arriving"), scratch_path(spark, "late")
    make_path(spark, f"{src}/arrived")
    rows = td.late_events(spark, d)
    _drops(spark, rows, "arrival", src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1_000).parquet(f"{src}/arrived/*")
    _feed(spark, late.split_late(stream, f"{out}/split", f"{out}/_split", STREAM_DELAY_SECONDS,
                                 batch=landing.MicroBatch(seconds=0)), src)
    clean = landing.dedupe_stream(late.read_on_time(spark, f"{out}/split", rows.schema, 1_000), watermark=f"{STREAM_DELAY_SECONDS} seconds")
    record_log.drain(clean.writeStream.format("parquet").option("path", f"{out}/kept")
                     .option("checkpointLocation", f"{out}/_kept").outputMode("append").start())
    on_time = spark.read.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{out}/split/on_time")
    one = lambda df, *flags: df.select("event_id", *[F.lit(x).alias(c) for c, x in zip(("kept", "on_time", "late"), flags)])
    return one(spark.read.schema(rows.schema).parquet(f"{out}/kept"), 1, 0, 0).unionByName(one(on_time, 0, 1, 0)) \
        .unionByName(one(late.read_late(spark, f"{out}/split", rows.schema), 0, 0, 1)).groupBy("event_id").agg(
            F.sum("kept").alias("kept"), (F.sum("on_time") - F.sum("kept")).alias("repeats"), F.sum("late").alias("late"))


# ----- sources: unions, drift, incremental ---------------------------------

SPLIT_TS = "2024-01-16 00:00:00"


def _before(col, ts=SPLIT_TS):
    """Earlier than a time, or without one."""
    return F.coalesce(F.col(col) < F.lit(ts).cast("timestamp_ntz"), F.lit(True))


def q_union_sources(spark, d):
    """Batch export (text) before the split, stream records after; one raw table."""
    split = F.lit(SPLIT_TS).cast("timestamp_ntz")
    # an event without a readable time is on the batch side, so none is on neither
    before = F.coalesce(F.col("event_ts").try_cast("timestamp_ntz") < split, F.lit(True))
    batch = td.batch_export(spark, d).filter(before)
    stream = records.good_records(records.decode_records(
        td.event_records(spark, d), ("event_id", "customer_id", "event_ts", "event_type", "props"))) \
        .filter(~before)
    raw = files.union_sources(batch, stream)
    return staged.apply_types(raw, td.CLICKSTREAM_TYPES)


def q_schema_drift_merged(spark, d):
    """A second file drops ``props`` and adds ``k`` (its parsed value); union under drift."""
    ev = td.table(spark, d, "events")
    first = ev.filter(_before("ts"))
    second = ev.filter(~_before("ts")).withColumn(
        "k", F.get_json_object("props", "$.k").try_cast("int")).drop("props")
    return files.merge_drifted(first, second)


def _drifting(spark, d):
    """The events as four files in which two columns change their types: ``reading`` goes from int over bigint to
    double, ``note`` from int over bigint and date to text."""
    ev, i = td.table(spark, d, "events"), F.col("event_id")
    big = i.cast("bigint") * 1_000_003 + 9_007_199_254_740_000
    columns = [(i.cast("int"), i.cast("int")), (big, big), (F.col("value"), F.to_date("ts")), (F.col("value"), F.col("event_type"))]
    return [ev.filter(i % 4 == k).select("event_id", reading.alias("reading"), note.alias("note"))
            for k, (reading, note) in enumerate(columns)]


def q_schema_drift_types(spark, d):
    """Four files with drifting types as one table of the least common types."""
    return files.merge_drifted(*_drifting(spark, d))


def q_schema_drift_losses(spark, d):
    """The values that lose digits when the drifting files are merged."""
    return files.drift_losses(spark, *_drifting(spark, d))


def q_csv_text_scan(spark, d):
    """All orders written as CSV with a header, scanned as text without inference, then typed."""
    out = scratch_path(spark, "orders-csv")
    orders = td.table(spark, d, "orders")
    files.write_table(orders, out, fmt="csv")
    return staged.apply_types(files.read_text_csv(spark, out, orders.columns), dict(orders.dtypes))


def q_zone_sql(spark, d):
    """Zone tables in place under SQL: customers and their orders per segment."""
    zone = scratch_path(spark, "zone")
    for t in ("customer", "orders"):
        files.write_table(td.table(spark, d, t), f"{zone}/{t}")
    files.register_zone(spark, zone, ["customer", "orders"], prefix="zone_")
    return spark.sql("""SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders
        FROM zone_customer LEFT JOIN zone_orders ON c_custkey = o_custkey GROUP BY c_mktsegment""")


def q_incremental_ingest(spark, d):
    """Two raw drops that overlap by six days, staged incrementally: each event once."""
    root = scratch_path(spark, "incremental")
    raw_dir, staged_dir = f"{root}/raw", f"{root}/staged"
    raw = td.raw_clickstream(spark, d)
    ts = F.col("event_ts").try_cast("timestamp_ntz")
    drops = [raw.filter(ts < F.lit("2024-01-16").cast("timestamp_ntz")),
             raw.filter(F.coalesce(ts >= F.lit("2024-01-10").cast("timestamp_ntz"), F.lit(True)))]

    def stage(batch):
        return staged.stage_clickstream(batch, types=td.CLICKSTREAM_TYPES, stamp=None)[1]

    for i, drop in enumerate(drops):
        drop.write.mode("overwrite").parquet(f"{raw_dir}/drop={i}")
        incremental.stage_incremental(spark, f"{raw_dir}/drop=*", raw.schema, stage, staged_dir,
                                      f"{root}/_checkpoint", ["event_id"], "event_date", "event_ts")
    return spark.read.parquet(staged_dir).drop("event_date")


# ----- storage lifecycle -----------------------------------------------------

RETENTION_AS_OF = "2001-08-15"


def q_retention_tiers(spark, d):
    return retention.partition_inventory(td.table(spark, d, "orders"), "o_orderdate",
                                         RETENTION_AS_OF, zone="raw")


def q_tier_cost(spark, d):
    return retention.tier_cost(q_retention_tiers(spark, d))


# ----- metrics and alarms ------------------------------------------------------

def _event_series(spark, d):
    return td.table(spark, d, "events").select(F.col("event_type").alias("metric"), "ts", "value")


def q_metric_rollup(spark, d):
    return metrics.rollup(_event_series(spark, d), 300)


def q_metric_alarm(spark, d):
    """Error events as a failure count: sum per 5 min > 0, missing = not breaching."""
    errors = td.table(spark, d, "events").filter(F.col("event_type") == "error") \
        .select(F.lit("errors").alias("metric"), "ts", F.lit(1.0).alias("value"))
    return metrics.metric_alarm(errors, ALARMS[1])


VALUE_ALARM = AlarmSpec("value_spike", "max", 300, 200.0, 2, ">", "missing")


def q_metric_alarm_consecutive(spark, d):
    """Max value per event type per 5 min above 200 in 2 consecutive periods with data."""
    return metrics.metric_alarm(_event_series(spark, d), VALUE_ALARM)


SILENCE_ALARM = AlarmSpec("value_silence", "max", 300, 200.0, 3, ">", "breaching")


def q_metric_alarm_intervals(spark, d):
    """Max value per event type above 200, or no event at all, in 3 periods of 5 minutes, without a grid of periods."""
    return metrics.alarm_intervals(metrics.period_stats(_event_series(spark, d), SILENCE_ALARM), SILENCE_ALARM)[0]


def q_stream_lag(spark, d):
    """Lag between the order and the shipping of a line, as an alarm: max per period above the limit, twice."""
    lines = td.order_lines(spark, d)
    return metrics.stream_lag_alarm(lines, arrival_col="ship_date", event_col="order_date")


STREAM_ALARM_DELAY = "1 minute"


def q_stream_alarm(spark, d):
    """The value alarm on the events as a stream in time order: periods that the watermark has closed."""
    src, out = scratch_path(spark, "series"), scratch_path(spark, "alarm")
    make_path(spark, f"{src}/arrived")
    series = _event_series(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    _drops(spark, series, "ts", src)
    stream = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 1_000).parquet(f"{src}/arrived/*")
    _feed(spark, alarms.stream_alarm(stream, VALUE_ALARM, STREAM_ALARM_DELAY, f"{out}/closed", f"{out}/_checkpoint",
                                     every="0 seconds"), src)
    return alarms.alarm_states(spark, f"{out}/closed", VALUE_ALARM) \
        .withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


def q_stream_alarm_kept(spark, d):
    """The silence alarm on the events as a stream: states kept from batch to batch, each fed by its closed periods only."""
    src, out = scratch_path(spark, "series"), scratch_path(spark, "kept-alarm")
    make_path(spark, f"{src}/arrived")
    series = _event_series(spark, d).withColumn("ts", F.col("ts").cast("timestamp"))
    _drops(spark, series, "ts", src, drops=4)
    stream = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 1_000).parquet(f"{src}/arrived/*")
    _feed(spark, alarms.kept_alarm(stream, SILENCE_ALARM, STREAM_ALARM_DELAY, out, f"{out}/_checkpoint", every="0 seconds"), src)
    return alarms.kept_states(spark, out).withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))


# ----- the whole run -----------------------------------------------------------

def q_medallion_customer_360(spark, d):
    """raw → staged → DQ gate → curated over the supplied tables; the published profile."""
    root = scratch_path(spark, "lake")
    res = run_medallion(spark, td.medallion_raw(spark, d), td.medallion_config(root))
    return res.curated["customer_360"]


def q_medallion_counts(spark, d):
    """Rows per zone and fact of a full run with its rejects and repeats, as the writes counted them."""
    root = scratch_path(spark, "lake-counts")
    counts = run_medallion(spark, td.medallion_raw(spark, d), td.medallion_config(root)).counts
    wanted = [(k, int(v)) for k, v in sorted(counts.items()) if k.split(".")[0] in ("raw", "staged", "rejected", "duplicate")]
    return spark.createDataFrame(wanted, "name string, rows long")


def q_medallion_incremental(spark, d):
    """Three drops and a replay, run incrementally; the published profile, which equals that of a full run."""
    root = scratch_path(spark, "lake-incremental")
    for drop in td.medallion_drops(spark, d):
        res = run_medallion(spark, drop, td.medallion_config(root, mode="incremental"))
    return res.curated["customer_360"]


def q_medallion_compacted(spark, d):
    """Three drops, run incrementally, small runs merged after each; the profile from the rows staged then."""
    root = scratch_path(spark, "lake-compacted")
    for drop in td.medallion_drops(spark, d)[:3]:
        conf = td.medallion_config(root, mode="incremental")
        run_medallion(spark, drop, conf)
        compact(spark, conf, fan=2)
    staged = read_staged_zone(spark, conf)
    return build_curated(td.customers(spark, d), staged["clickstream_events"], staged["transactions"], td.products(spark, d),
                         conf.funnel, completed_value=conf.completed_value)["customer_360"]


def q_medallion_full_then_incremental(spark, d):
    """What each of four runs over one set of files took in: rows per zone and fact.

    A full run, an incremental one after more files have arrived (order lines, and the events once more as
    records landed by a stream), one after the missing customers have come, and one with nothing new.
    No file is read twice, and rows of unknown customers are pending once until their customer comes.
    """
    root = scratch_path(spark, "arrivals")
    known, late = td.late_customers(spark, d)
    even, odd = td.line_files(spark, d)

    def put(df, table, name):
        files.write_table(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), f"{root}/in/{table}/{name}")

    sources = {t: [lake.Source(t, f"{root}/in/{t}", "parquet")] for t in ("customers", "products", "clickstream_events", "transactions")}
    sources["clickstream_events"].append(lake.Source("clickstream_events/landed", f"{root}/landed/good", "parquet", optional=True))
    first = {"customers": known, "products": td.products(spark, d), "clickstream_events": td.batch_export(spark, d), "transactions": even}
    columns = {t: df.columns for t, df in first.items()}
    counts = []

    def run(mode):
        got = run_sources(spark, sources, td.medallion_config(f"{root}/lake", mode=mode), columns).counts
        counts.extend((len(counts) // 10 + 1, f"{zone}.{fact}", int(got[f"{zone}.{fact}"])) for fact in ("clickstream_events", "transactions")
                      for zone in ("raw", "staged", "rejected", "pending", "duplicate"))

    for t, df in first.items():
        put(df, t, "first")
    run("full")
    put(odd, "transactions", "second")
    _landed(spark, _record_source(spark, d), f"{root}/landed", _files_a_batch(spark, d))
    run("incremental")
    put(late, "customers", "second")
    run("incremental")
    run("incremental")
    delete_path(spark, root)
    return spark.createDataFrame(counts, "step int, name string, rows long")


QUERIES: dict[str, QueryFn] = {
    "customer_profile": q_customer_profile,
    "customer_funnel": q_customer_funnel,
    "customer_spend": q_customer_spend,
    "category_performance": q_category_performance,
    "top_categories": q_top_categories,
    "funnel_dropoff": q_funnel_dropoff,
    "event_type_counts": q_event_type_counts,
    "avg_conversion": q_avg_conversion,
    "coerce_numeric": q_coerce_numeric,
    "stage_clickstream": q_stage_clickstream,
    "stage_clickstream_rejects": q_stage_clickstream_rejects,
    "stage_transactions": q_stage_transactions,
    "stage_transactions_rejects": q_stage_transactions_rejects,
    "dedupe_first": q_dedupe_first,
    "semi_join_valid": q_semi_join_valid,
    "semi_join_known_keys": q_semi_join_known_keys,
    "anti_join_new_keys": q_anti_join_new_keys,
    "stage_faulty_transactions": q_stage_faulty_transactions,
    "stage_faulty_transactions_rejects": q_stage_faulty_transactions_rejects,
    "category_performance_orphans": q_category_performance_orphans,
    "dq_completeness": q_dq_completeness,
    "dq_uniqueness": q_dq_uniqueness,
    "dq_uniqueness_composite": q_dq_uniqueness_composite,
    "dq_referential_integrity": q_dq_referential_integrity,
    "dq_freshness": q_dq_freshness,
    "dq_suite": q_dq_suite,
    "dq_suite_summary": q_dq_suite_summary,
    "dq_suite_faulty": q_dq_suite_faulty,
    "dq_freshness_text": q_dq_freshness_text,
    "dq_results_retry": q_dq_results_retry,
    "json_decode": q_json_decode,
    "json_dead_letter": q_json_dead_letter,
    "json_decode_faulty": q_json_decode_faulty,
    "json_dead_letter_faulty": q_json_dead_letter_faulty,
    "stream_landing": q_stream_landing,
    "stream_landing_progress": q_stream_landing_progress,
    "stream_landing_bounded": q_stream_landing_bounded,
    "stream_batch_convergence": q_stream_batch_convergence,
    "stream_dedupe": q_stream_dedupe,
    "stream_late_rows": q_stream_late_rows,
    "union_sources": q_union_sources,
    "schema_drift_merged": q_schema_drift_merged,
    "schema_drift_types": q_schema_drift_types,
    "schema_drift_losses": q_schema_drift_losses,
    "incremental_ingest": q_incremental_ingest,
    "csv_text_scan": q_csv_text_scan,
    "zone_sql": q_zone_sql,
    "retention_tiers": q_retention_tiers,
    "tier_cost": q_tier_cost,
    "metric_rollup": q_metric_rollup,
    "metric_alarm": q_metric_alarm,
    "metric_alarm_consecutive": q_metric_alarm_consecutive,
    "stream_lag": q_stream_lag,
    "stream_alarm": q_stream_alarm,
    "metric_alarm_intervals": q_metric_alarm_intervals,
    "stream_alarm_kept": q_stream_alarm_kept,
    "medallion_customer_360": q_medallion_customer_360,
    "medallion_incremental": q_medallion_incremental,
    "medallion_counts": q_medallion_counts,
    "medallion_full_then_incremental": q_medallion_full_then_incremental,
    "medallion_compacted": q_medallion_compacted,
}


def main(argv=None) -> int:
    """``python -m tidemark.plans.registry QUERY --sf-dir DIR [--out PATH] [--format parquet]``.

    Runs one registered query over the tables in DIR; writes the result to
    PATH (Parquet, CSV or JSON), or shows the first rows when no PATH is given.
    """
    import argparse

    from tidemark.session import cluster_conf, get_session
    from tidemark.sources.files import write_table

    ap = argparse.ArgumentParser(prog="tidemark-query")
    ap.add_argument("query", choices=sorted(QUERIES))
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", default=None)
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    ap.add_argument("--master", default=None)
    ap.add_argument("--cores", type=int, default=None, help="size the session for a cluster of so many cores")
    ap.add_argument("--input-tb", type=float, default=1.0)
    args = ap.parse_args(argv)
    spark = get_session(args.master, extra_conf=cluster_conf(args.cores, args.input_tb) if args.cores else None)
    df = QUERIES[args.query](spark, args.sf_dir)
    if args.out:
        n = write_table(df, args.out, fmt=args.format)
        print(f"{args.query}: {n:,} rows written to {args.out}")
    else:
        df.show(20, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
