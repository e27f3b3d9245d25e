"""Stream → raw zone landing (X1, X2, X4, K5, K7, K8) and stream dedupe.

``land_stream`` runs one streaming query whose ``foreachBatch`` writes the
good records and the dead letters of micro-batch N to ``.../batch_id=N``
with overwrite. A replayed batch (after a driver or executor failure)
rewrites exactly the same directories, so the landing is idempotent; the
checkpoint records progress (the commit). An empty batch writes nothing.
A source that numbers its batches (``record_log``) may hand over several of them in one micro-batch of Spark; each is
landed in a folder of its own all the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import (STREAM_BATCH_WINDOW_SECONDS, STREAM_MAX_RECORDS_PER_BATCH,
                             STREAM_RETENTION)
from tidemark.functions.scalar import is_present
from tidemark.operators.cleanse import tag_rejects, valid_rows
from tidemark.session import together
from tidemark.streaming.records import (CLICKSTREAM_FIELDS, DEAD_LETTER_COL, decode_records)


PROGRESS = "batch_id long, landed long, dead long"


@dataclass(frozen=True)
class MicroBatch:
    """Micro-batch bound: at most ``max_records`` per batch or one per ``seconds``."""

    max_records: int = STREAM_MAX_RECORDS_PER_BATCH
    seconds: int = STREAM_BATCH_WINDOW_SECONDS

    def source_options(self, source_format: str, files_per_batch: int = 1) -> dict:
        """Per-trigger limits. A file source can only be bounded by files: its producer bounds the
        records of a file (``maxRecordsPerFile``), so a batch has at most files x records."""
        if source_format == "kafka":
            return {"maxOffsetsPerTrigger": str(self.max_records)}
        if source_format == "rate":
            return {}
        if files_per_batch < 1:
            raise ValueError("files_per_batch must be positive: a batch is always bounded")
        return {"maxFilesPerTrigger": str(files_per_batch)}

    def trigger(self, available_now: bool = False) -> dict:
        return {"availableNow": True} if available_now else \
            {"processingTime": f"{self.seconds} seconds"}


def read_records(spark: SparkSession, path: str, fmt: str = "parquet",
                 batch: MicroBatch = MicroBatch(), files_per_batch: int = 1) -> DataFrame:
    """A file-backed record stream (sequence_number, value)."""
    return (spark.readStream.format(fmt).schema("sequence_number string, value string")
            .options(**batch.source_options(fmt, files_per_batch)).load(path))


def land_stream(records: DataFrame, landing_path: str, dead_letter_path: str,
                checkpoint_path: str, fields: Sequence[str] = CLICKSTREAM_FIELDS,
                fmt: str = "parquet", batch: MicroBatch = MicroBatch(),
                available_now: bool = False, query_name: str | None = None,
                progress_path: str | None = None, batch_col: str | None = None) -> StreamingQuery:
    """Decode each micro-batch and land good rows and dead letters (idempotently).

    With ``progress_path`` every batch leaves one row there (batch_id, landed, dead): a
    complete history, however long the query runs. ``fmt`` is the landed format: ``parquet`` (default) or ``json`` (NDJSON).
    Good rows get ``_ingested_ts`` (arrival time, for stream-lag metrics). With ``batch_col``, a column of ``records`` that
    never changes when a record is read again, a record's batch is the one named there, not Spark's.
    """
    kept = [F.col(batch_col).alias("batch_id")] if batch_col else []
    decoded = decode_records(records.select("sequence_number", "value", *kept), fields, keep=["batch_id"] if kept else []).withColumn("_ingested_ts", F.current_timestamp())

    def write_batches(batch_df: DataFrame, batch_id: int) -> None:
        # The batches of a micro-batch are whole in it, so a repeat replaces exactly their folders.
        batch_df.persist()
        try:
            good, spark = F.col(DEAD_LETTER_COL).isNull(), batch_df.sparkSession
            n_good, n_bad = batch_df.agg(F.count_if(good), F.count_if(~good)).first()
            tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

            def save(rows: DataFrame, path: str) -> None:
                rows.repartition(tasks, "batch_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                    .partitionBy("batch_id").format(fmt).save(path)

            ways = []
            if n_good:
                ways.append(lambda: save(batch_df.filter(good).drop(DEAD_LETTER_COL, "_payload"), landing_path))
            if n_bad:
                ways.append(lambda: save(batch_df.filter(~good).select("_sequence_number", "_payload", DEAD_LETTER_COL, "_ingested_ts", "batch_id"),
                                         dead_letter_path))
            together(*ways)
            if progress_path and ways:
                batch_df.groupBy("batch_id").agg(F.count_if(good).alias("landed"), F.count_if(~good).alias("dead")) \
                    .coalesce(1).write.mode("overwrite").parquet(f"{progress_path}/part_{batch_id}")
        finally:
            batch_df.unpersist()

    def write_batch(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()   # a micro-batch is bounded by the trigger limits; read it once
        try:
            good = F.col(DEAD_LETTER_COL).isNull()
            n_good, n_bad = batch_df.agg(F.count_if(good), F.count_if(~good)).first()
            if not n_good + n_bad:
                return
            ways = []
            if n_good:
                ways.append(lambda: batch_df.filter(good).drop(DEAD_LETTER_COL, "_payload").write.mode("overwrite")
                            .format(fmt).save(f"{landing_path}/batch_id={batch_id}"))
            if n_bad:
                ways.append(lambda: batch_df.filter(~good).select("_sequence_number", "_payload", DEAD_LETTER_COL, "_ingested_ts")
                            .write.mode("overwrite").format(fmt).save(f"{dead_letter_path}/batch_id={batch_id}"))
            together(*ways)
            if progress_path:
                batch_df.sparkSession.range(1).select(
                    F.lit(batch_id).cast("long").alias("batch_id"), F.lit(n_good).alias("landed"), F.lit(n_bad).alias("dead")) \
                    .coalesce(1).write.mode("overwrite").parquet(f"{progress_path}/part_{batch_id}")
        finally:
            batch_df.unpersist()

    writer = decoded.writeStream.foreachBatch(write_batches if batch_col else write_batch) \
        .option("checkpointLocation", checkpoint_path).trigger(**batch.trigger(available_now))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def dedupe_stream(stream: DataFrame, key: Sequence[str] = ("event_id",), ts_col: str = "event_ts",
                  watermark: str = STREAM_RETENTION) -> DataFrame:
    """Drop repeats of a key seen within the watermark (stream retention).

    The event time is cast to ``timestamp`` (watermarks reject
    ``timestamp_ntz``). A row that is later than the watermark of the batch
    before is left out (``alarms.late_rows`` counts them), and a repeat that comes after
    its key expired passes again: the batch dedupe over the landed records, which holds
    every row, stays the final authority.
    """
    ts = F.col(ts_col).cast("string").try_cast("timestamp") \
        if dict(stream.dtypes).get(ts_col) == "string" else F.col(ts_col).cast("timestamp")
    return stream.withColumn(ts_col, ts).withWatermark(ts_col, watermark) \
        .dropDuplicatesWithinWatermark(list(key))


def stage_clickstream_stream(stream: DataFrame, key: Sequence[str] = ("event_id",),
                             customer: str = "customer_id", ts_col: str = "event_ts",
                             watermark: str = STREAM_RETENTION) -> DataFrame:
    """The staged clickstream rule on a stream: drop anonymous rows, dedupe within the watermark."""
    valid = valid_rows(tag_rejects(stream, [("missing_customer", is_present(customer))]))
    return dedupe_stream(valid, key, ts_col, watermark)


def kafka_records(spark: SparkSession, bootstrap_servers: str, topic: str,
                  batch: MicroBatch = MicroBatch(), starting_offsets: str = "latest") -> DataFrame:
    """A Kafka-backed record stream (sequence_number, value), starting at the latest offset.

    Needs the ``spark-sql-kafka`` package on the cluster's classpath (not in
    the local test image). The record key becomes ``sequence_number``
    (partition:offset when the key is empty); the base64 text is the value.
    """
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", bootstrap_servers).option("subscribe", topic)
           .option("startingOffsets", starting_offsets)
           .options(**batch.source_options("kafka")).load())
    seq = F.coalesce(F.col("key").cast("string"),
                     F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")))
    return raw.select(seq.alias("sequence_number"), F.col("value").cast("string").alias("value"))


def landing_progress(spark: SparkSession, progress_path: str) -> DataFrame:
    """(batch_id, landed, dead): one row for every micro-batch that landed records."""
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", True).parquet(progress_path)


def batch_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch_id, num_input_rows, input_rows_per_second) of the query's latest batches.

    The rates come from the progress reports the query still keeps
    (``spark.sql.streaming.numRecentProgressUpdates``); the complete counts are those of
    ``landing_progress``.
    """
    rows = [(int(p["batchId"]), int(p["numInputRows"]), float(p.get("inputRowsPerSecond") or 0.0))
            for p in query.recentProgress]
    return spark.createDataFrame(
        rows, "batch_id long, num_input_rows long, input_rows_per_second double")
