"""Incremental staging (S6, V16): only new data is staged, and the result equals a full run.

Two entry points share the rules:

* ``stage_incremental``: a file-source stream with ``trigger(availableNow=True)``; its
  checkpoint is the bookmark. Each micro-batch is cleaned, anti-joined against
  *all* keys staged so far (the key columns only, whatever dates they have)
  and appended. A replayed batch appends nothing: its keys are staged.

* ``stage_fact``: one run of the medallion. Tables hold a partition ``_run`` per run, and readers see
  a run only once it is committed (``tidemark.plans.lake``); what a failed run wrote is never read. What was rejected because its customer was unknown stays
  *pending* and is judged again with every run's customers. Of two rows of a key the one
  that arrived in the earlier run is kept, as in a full run: if a pending row is
  released after a later one was staged, the later row is marked superseded.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleanse import REJECT_COL, rejected_rows
from tidemark.operators.joins import new_keys
from tidemark.plans.staged import RAW_COL
from tidemark.session import delete_path, scratch_path, together
from tidemark.sources.files import spread_by, table_exists

# A staging rule for one micro-batch: returns the clean rows, or (tagged, clean)
# when the rejected rows should be written too.
StageFn = Callable[[DataFrame], "DataFrame | tuple[DataFrame, DataFrame]"]


def stage_incremental(spark: SparkSession, raw_path: str, raw_schema: T.StructType,
                      stage: StageFn, staged_path: str, checkpoint: str,
                      key: Sequence[str], partition_col: str, date_from: str,
                      fmt: str = "parquet", rejects_path: str | None = None) -> None:
    """Process the raw files that are new since the last run; append new keys.

    Rows with a NULL key say nothing about identity and are left out (staging
    rejects them). With ``rejects_path`` (and a ``stage`` returning ``(tagged, clean)``) the
    rejected rows of micro-batch N are written to ``rejects_path/batch_id=N``
    with overwrite, so a replayed batch rewrites the same files.
    """
    def process(batch: DataFrame, batch_id: int) -> None:
        staged_rows = stage(batch)
        if isinstance(staged_rows, tuple):
            tagged, clean = staged_rows
            if rejects_path:
                rejected_rows(tagged).select(f"{RAW_COL}.*", REJECT_COL).write.mode("overwrite") \
                    .parquet(f"{rejects_path}/batch_id={batch_id}")
        else:
            clean = staged_rows
        clean = clean.dropna(subset=list(key)).withColumn(partition_col, F.to_date(date_from))
        if table_exists(spark, staged_path):
            clean = new_keys(clean, spark.read.parquet(staged_path), list(key))
        spread_by(clean, [partition_col]).write.mode("append").partitionBy(partition_col).parquet(staged_path)

    q = (spark.readStream.format(fmt).schema(raw_schema).load(raw_path)
         .writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ----- runs of a lake ----------------------------------------------------------

RUN, ARRIVED, COPIES = "_run", "_arrived", "_copies"


def run_path(table: str, run: int) -> str:
    return f"{table}/{RUN}={run}"


def read_runs(spark: SparkSession, table: str, schema: T.StructType, runs: Sequence[int]) -> DataFrame:
    """The rows of some runs, with their run; a run that wrote no row has none."""
    if not runs:
        return spark.createDataFrame([], schema).withColumn(RUN, F.lit(0))
    fields = [f for f in schema.fields if f.name != RUN]
    return spark.read.schema(T.StructType([*fields, T.StructField(RUN, T.IntegerType())])) \
        .option("basePath", table).parquet(*[run_path(table, r) for r in runs])


def write_run(df: DataFrame, table: str, run: int, partition_by: Sequence[str] = ()) -> int:
    """Write (or write again) one run of a table; the number of rows."""
    obs = Observation("rows")
    w = spread_by(df, partition_by).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(run_path(table, run))
    return int(obs.get["rows"])


@dataclass(frozen=True)
class Fact:
    """How a fact is staged. ``tag`` gives typed rows with a reason and the row as it arrived."""

    name: str
    key: tuple[str, ...]
    order_by: tuple[str, ...]
    partition_by: str
    tag: Callable[[DataFrame], DataFrame]


def staged_path(lake: str, fact: str) -> str:
    return f"{lake}/staged/{fact}"


def reject_path(lake: str, fact: str, kind: str) -> str:
    return f"{lake}/staged/_{kind}/{fact}"


def read_staged(spark: SparkSession, lake: str, fact: Fact, schema: T.StructType, runs: Sequence[int]) -> DataFrame:
    """The staged rows of some runs without those that an earlier arrival superseded.

    Only the rows of runs that hold such rows are compared with the marks; which runs these are is looked up at once.
    """
    gone = read_runs(spark, reject_path(lake, fact.name, "superseded"), superseded_schema(schema, fact), runs)
    held = {r[0] for r in gone.select("_of").distinct().collect()}                      # runs
    table, whole = staged_path(lake, fact.name), [r for r in runs if r not in held]
    if not held.intersection(runs):
        return read_runs(spark, table, schema, runs)
    rows = read_runs(spark, table, schema, [r for r in runs if r in held])
    gone = gone.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(fact.key)], F.col("_of").alias("_gone"))
    same = F.col(RUN) == F.col("_gone")
    for i, k in enumerate(fact.key):
        same = same & (F.col(k) == F.col(f"_k{i}"))
    live = rows.join(gone, same, "left_anti")
    return live.unionByName(read_runs(spark, table, schema, whole)) if whole else live


def superseded_schema(schema: T.StructType, fact: Fact) -> T.StructType:
    return T.StructType([schema[k] for k in fact.key] + [T.StructField("_of", T.IntegerType())])


def superseded_rows(spark: SparkSession, lake: str, fact: Fact, schema: T.StructType, run: int, runs: Sequence[int]) -> DataFrame:
    """The staged rows of earlier runs that ``run`` superseded; only the runs that held them are read."""
    gone = spark.read.schema(superseded_schema(schema, fact)).parquet(run_path(reject_path(lake, fact.name, "superseded"), run))
    held = sorted(r[0] for r in gone.select("_of").distinct().collect())                # runs
    rows = read_runs(spark, staged_path(lake, fact.name), schema, [r for r in runs if r in held])
    gone = gone.withColumnRenamed("_of", RUN)
    return rows.join(gone, [*fact.key, RUN], "left_semi").drop(RUN)


def stage_fact(spark: SparkSession, lake: str, fact: Fact, raw: DataFrame, run: int,
               runs: Sequence[int]) -> tuple[T.StructType, dict[str, int]]:
    """Stage one run of a fact on top of the committed ``runs``.

    ``raw`` holds the run's rows as they arrived. Returns the staged schema and counts:
    raw and pending rows taken in; staged, rejected, duplicate, pending and superseded rows.
    Raises if a row was lost or made up on the way.
    """
    raw_schema = raw.schema
    pending_schema = T.StructType([*raw_schema.fields, T.StructField(ARRIVED, T.IntegerType())])
    rows = raw.withColumn(ARRIVED, F.lit(run))
    if runs:
        old = read_runs(spark, reject_path(lake, fact.name, "pending"), pending_schema, runs[-1:]).drop(RUN)
        rows = rows.unionByName(old)
    # One pass over the input: typed, judged and written, split by reason. The text as it
    # arrived is only kept for rows that were refused.
    tagged = fact.tag(rows)
    tagged = tagged.withColumn(RAW_COL, F.when(F.col(REJECT_COL).isNotNull(), F.col(RAW_COL))) \
        .withColumn("_class", F.when(F.col(REJECT_COL).isNull(), "valid")
                    .when(F.col(REJECT_COL) == "unknown_customer", "pending").otherwise("rejected"))
    work = scratch_path(spark, f"tagged-{fact.name}")
    taken = Observation("taken")
    tagged.observe(taken, F.count(F.lit(1)).alias("n")).write.partitionBy("_class").parquet(work)
    judged = spark.read.schema(tagged.schema).parquet(work)

    counts = {"taken": int(taken.get["n"])}
    pending = judged.filter("_class = 'pending'").select(f"{RAW_COL}.*")
    content = [c for c in tagged.columns if c not in (RAW_COL, REJECT_COL, "_class")]
    valid = judged.filter("_class = 'valid'").select(*content)
    order = [ARRIVED, *[c for c in fact.order_by if c not in fact.key]]
    rest = [c for c in content if c not in fact.key and c not in order]
    first = valid.groupBy(*fact.key).agg(F.min(F.struct(*order, *rest)).alias("_first"), F.count(F.lit(1)).alias(COPIES)) \
        .select(*[F.col(c) if c in fact.key else F.col(f"_first.`{c}`").alias(c) for c in content], COPIES)
    schema = T.StructType([f for f in first.schema.fields if f.name != COPIES])
    # All history, but only its keys and when they arrived.
    history = read_staged(spark, lake, fact, schema, runs).select(
        *fact.key, F.col(ARRIVED).alias("_since"), F.col(RUN).alias("_of"))
    earlier = F.col("_of").isNull() | (F.col(ARRIVED) < F.col("_since"))
    met = first.join(history, list(fact.key), "left").withColumn("_earlier", earlier) if runs else \
        first.withColumns({"_of": F.lit(None).cast("int"), "_earlier": F.lit(True)})
    met_work = scratch_path(spark, f"met-{fact.name}")
    # The join with history is done once, its outcome read thrice.
    counts["pending"], _ = together(lambda: write_run(pending, reject_path(lake, fact.name, "pending"), run),
                                    lambda: met.write.parquet(met_work))
    met = spark.read.schema(met.schema).parquet(met_work)
    earlier = F.col("_earlier")
    # Repeats of a key are one row with their number; only the key is left of them.
    repeats = met.select(*[F.col(k).cast("string").alias(k) for k in fact.key],
                         (F.col(COPIES) - F.when(earlier, 1).otherwise(0)).alias(COPIES)) \
        .filter(F.col(COPIES) > 0).withColumn(REJECT_COL, F.lit("duplicate"))
    refused = judged.filter("_class = 'rejected'").select(f"{RAW_COL}.*", REJECT_COL).withColumn(COPIES, F.lit(1).cast("bigint"))
    duplicates = Observation("duplicates")
    rejects = refused.unionByName(repeats, allowMissingColumns=True).observe(
        duplicates, F.sum(F.when(F.col(REJECT_COL) == "duplicate", F.col(COPIES))).alias("n"),
        F.count_if(F.col(REJECT_COL) != "duplicate").alias("refused"))
    kept = met.filter(earlier)
    counts["staged"], counts["superseded"], _ = together(
        lambda: write_run(kept.select(*content), staged_path(lake, fact.name), run, [fact.partition_by]),
        lambda: write_run(kept.filter(F.col("_of").isNotNull()).select(*fact.key, "_of"), reject_path(lake, fact.name, "superseded"), run),
        lambda: write_run(rejects, reject_path(lake, fact.name, "rejects"), run))
    counts["duplicate"], counts["rejected"] = int(duplicates.get["n"] or 0), int(duplicates.get["refused"])
    delete_path(spark, work)
    delete_path(spark, met_work)
    found = counts["staged"] + counts["duplicate"] + counts["rejected"] + counts["pending"]
    if found != counts["taken"]:
        raise RuntimeError(f"{fact.name}: {counts['taken']} rows came in, {found} are accounted for: {counts}")
    return schema, counts
