"""Alarms on a stream (R4, R5): periods closed by a watermark, states from the closed periods.

The stream part is a built-in window aggregation, so a metric that holds most of
the events is combined before its shuffle and no event passes through Python. In append mode a
period leaves the aggregation once, when the watermark has passed its end;
``foreachBatch`` writes the closed periods of micro-batch N to ``batch_id=N`` with overwrite,
so a replayed batch changes nothing. States need the periods before, a few rows per
metric: they are evaluated over the closed periods by the batch rule.

An event later than the watermark cannot change a closed period. ``late_rows`` counts
them, and ``metrics.metric_alarm`` over the landed series is the authority that
includes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import AlarmSpec
from tidemark.operators.metrics import CARRY, alarm_intervals, evaluate_periods, period_stats
from tidemark.plans.lake import list_names
from tidemark.session import delete_path, together

_CLOSED = "metric string, period_start timestamp, stat_value double"


def closed_periods(series: DataFrame, spec: AlarmSpec, watermark: str, metric_col: str = "metric",
                   ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """(metric, period_start, stat_value) of a stream, one row per period once it is closed."""
    prepared = series.select(F.col(metric_col).cast("string").alias("metric"), F.col(ts_col).cast("timestamp").alias("ts"),
                             F.col(value_col).alias("value")).withWatermark("ts", watermark)
    return period_stats(prepared, spec)


def stream_alarm(series: DataFrame, spec: AlarmSpec, watermark: str, path: str, checkpoint: str,
                 metric_col: str = "metric", ts_col: str = "ts", value_col: str = "value",
                 available_now: bool = False, every: str | None = None) -> StreamingQuery:
    """Start the query that writes closed periods below ``path``, a batch per period or ``every`` interval."""
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one row per metric and closed period
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = closed_periods(series, spec, watermark, metric_col, ts_col, value_col).writeStream \
        .outputMode("append").foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every or f"{spec.period_seconds} seconds"}
    return writer.trigger(**trigger).start()


def alarm_states(spark: SparkSession, path: str, spec: AlarmSpec) -> DataFrame:
    """(metric, period_start, stat_value, breaching, state) of the periods closed so far."""
    closed = spark.read.schema(_CLOSED).option("recursiveFileLookup", True).parquet(path)
    return evaluate_periods(closed, spec)


def late_rows(query: StreamingQuery) -> int:
    """Events left out as later than the watermark, over the progress reports the query keeps."""
    return sum(int(op.get("numRowsDroppedByWatermark") or 0)
               for p in query.recentProgress for op in p["stateOperators"])


# ----- states kept between batches ---------------------------------------------------

_STATES = "metric string, period_start timestamp, periods long, stat_value double, breaching boolean, state string"


def _carry_before(spark: SparkSession, path: str, batch_id: int | None) -> DataFrame | None:
    held = [int(n.split("=")[1]) for n in list_names(spark, f"{path}/carry") if n.startswith("batch_id=")]
    held = [b for b in held if batch_id is None or b < batch_id]
    return spark.read.schema(CARRY).parquet(f"{path}/carry/batch_id={max(held)}") if held else None


def keep_batch(closed: DataFrame, batch_id: int, spec: AlarmSpec, path: str) -> None:
    """Evaluate a batch's closed periods on top of what the batches before left, one row per metric."""
    spark = closed.sparkSession
    closed = closed.persist()                 # one row per metric and period
    try:
        if closed.isEmpty():
            return
        states, carry = alarm_intervals(closed, spec, _carry_before(spark, path, batch_id))
        together(lambda: states.write.mode("overwrite").parquet(f"{path}/states/batch_id={batch_id}"),
                 lambda: carry.select("metric", "last", "reset", "n").write.mode("overwrite").parquet(f"{path}/carry/batch_id={batch_id}"))
    finally:
        closed.unpersist()
    # the carry before this one stays, for a replay of the batch
    held = sorted(int(n.split("=")[1]) for n in list_names(spark, f"{path}/carry") if n.startswith("batch_id="))
    for old in held[:-2]:
        delete_path(spark, f"{path}/carry/batch_id={old}")


def kept_alarm(series: DataFrame, spec: AlarmSpec, watermark: str, path: str, checkpoint: str, metric_col: str = "metric",
               ts_col: str = "ts", value_col: str = "value", every: str | None = None) -> StreamingQuery:
    """Start the query that keeps alarm states: each batch evaluates its closed periods alone.

    Batch N reads one row per metric that the batch before it left in ``path/carry`` and writes its states to
    ``path/states/batch_id=N``, so a replay writes the same again and no closed period is read twice.
    """
    return closed_periods(series, spec, watermark, metric_col, ts_col, value_col).writeStream.outputMode("append") \
        .foreachBatch(lambda batch, batch_id: keep_batch(batch, batch_id, spec, path)).option("checkpointLocation", checkpoint) \
        .trigger(processingTime=every or f"{spec.period_seconds} seconds").start()


def kept_states(spark: SparkSession, path: str) -> DataFrame:
    """(metric, period_start, periods, stat_value, breaching, state) of all batches so far."""
    return spark.read.schema(_STATES).option("recursiveFileLookup", True).parquet(f"{path}/states")


def latest_carry(spark: SparkSession, path: str) -> DataFrame:
    """What the last batch left: with ``metrics.silent_states`` the present state of metrics that have gone silent."""
    carry = _carry_before(spark, path, None)
    return carry if carry is not None else spark.createDataFrame([], CARRY)
