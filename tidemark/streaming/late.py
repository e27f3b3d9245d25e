"""Rows behind the watermark as an output of their own.

Spark's stateful operators leave rows out that are later than the watermark. ``split_late`` stands
before them: it compares every micro-batch with the watermark of the batches before (latest event time less the
delay), writes rows behind it, or without a readable time, to a side output, and the others to a landing
that stateful queries read as their stream. Such a query reads the landing in order, so its own watermark is
never ahead of the one a row was compared with, and none of its rows is late: kept + repeats + late is the input.

Micro-batch N is written to ``batch_id=N`` with overwrite, and the watermark of a batch comes from the
progress rows of earlier ones only, so a replayed batch gives the same files. One pass over the batch counts it, no
row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.lake import list_names
from tidemark.session import together
from tidemark.streaming.landing import MicroBatch

REASON = "_late_reason"
PROGRESS = "batch_id long, on_time long, late long, latest_us long"


def _time_us(df: DataFrame, ts_col: str) -> Column:
    ts = F.col(ts_col)
    return F.unix_micros(ts.try_cast("timestamp") if dict(df.dtypes)[ts_col] == "string" else ts.cast("timestamp"))


def latest_before(spark: SparkSession, progress_path: str, batch_id: int) -> int | None:
    """The latest event time (microseconds) of all batches before ``batch_id``; each progress row carries it on."""
    before = [int(n.split("_")[1]) for n in list_names(spark, progress_path) if n.startswith("part_")]
    before = [b for b in before if b < batch_id]
    if not before:
        return None
    return spark.read.schema(PROGRESS).parquet(f"{progress_path}/part_{max(before)}").first()["latest_us"]


def split_late(stream: DataFrame, path: str, checkpoint: str, delay_seconds: int, ts_col: str = "event_ts",
               batch: MicroBatch = MicroBatch()) -> StreamingQuery:
    """Start the query that writes ``path/on_time``, ``path/late`` (with ``_late_reason``) and ``path/progress``."""
    def write_batch(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        before = latest_before(spark, f"{path}/progress", batch_id)
        at = _time_us(rows, ts_col)
        # as Spark has it: watermarks start at the epoch, and a row at the watermark is late
        watermark = max(0, before - delay_seconds * 1_000_000) if before is not None else 0
        reason = F.when(at.isNull(), "no_time").when(at <= watermark, "late")
        tagged = rows.withColumn(REASON, reason).persist()       # bounded by the source's admission; read once
        try:
            late, n, latest = tagged.agg(F.count(REASON), F.count(F.lit(1)), F.max(at)).first()
            if not n:
                return
            latest = max((x for x in (before, latest) if x is not None), default=None)
            ways = []
            if n > late:
                ways.append(lambda: tagged.filter(F.col(REASON).isNull()).drop(REASON).write.mode("overwrite")
                            .parquet(f"{path}/on_time/batch_id={batch_id}"))
            if late:
                ways.append(lambda: tagged.filter(F.col(REASON).isNotNull()).write.mode("overwrite")
                            .parquet(f"{path}/late/batch_id={batch_id}"))
            together(*ways)
            # the row that commits the batch's watermark comes last
            spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(n - late).cast("long").alias("on_time"),
                                  F.lit(late).cast("long").alias("late"), F.lit(latest).cast("long").alias("latest_us")) \
                .coalesce(1).write.mode("overwrite").parquet(f"{path}/progress/part_{batch_id}")
        finally:
            tagged.unpersist()

    return stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(**batch.trigger()).start()


def read_on_time(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """The on-time rows as a stream, oldest files first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch) \
        .parquet(f"{path}/on_time/batch_id=*")


def read_late(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows behind the watermark, with their reason; none if no batch had any."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + f", {REASON} string"
    names = [n for n in list_names(spark, f"{path}/late") if n.startswith("batch_id=")]
    return spark.read.schema(fields).parquet(*[f"{path}/late/{n}" for n in names]) if names else spark.createDataFrame([], fields)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id, on_time, late, latest_us): one row for every micro-batch with rows."""
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(f"{path}/progress")
