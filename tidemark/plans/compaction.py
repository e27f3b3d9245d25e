"""Compaction of a lake's runs (K3): many small runs become few larger ones.

Every incremental run leaves a partition ``_run`` of small files in the staged zone. ``compact`` merges runs
of like size (size tiers): as soon as ``fan`` runs are of one tier they become one run of the next, so a
lake of n bytes keeps fewer than ``fan`` runs in each of about log(n / unit) tiers and a row is rewritten
about once per tier, however many runs there were.

A compaction is a version of the log like a run's: it takes a run number, writes the merged rows to folders
nobody reads yet, and becomes visible with its record. A concurrent run makes the later commit fail. Merged
runs' folders stay for ``lake.KEEP`` more versions, so readers of an older version finish undisturbed.

Every row keeps when it arrived, so of two rows of a key the earlier still wins in later runs. Rows that an
earlier arrival superseded are left out for good; marks on rows of runs that are not merged are carried on.
The last run is never merged: its pending rows are those that the next run judges again.

Defined results: an empty lake or one without ``fan`` runs of a tier stays at its version; runs without rows are
merged like others; nulls, repeated rows and columns of any type are copied as they are.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import incremental as inc
from tidemark.plans import lake as log
from tidemark.plans.medallion import FACTS, MedallionConfig, facts, forget
from tidemark.session import together

FAN = 8
UNIT = 128 << 20


def run_bytes(spark: SparkSession, lake: str, runs: Sequence[int]) -> dict[int, int]:
    """Bytes of each run's staged facts. One listing per run and fact; compaction keeps the runs few."""
    def size(path: str) -> int:
        p, fs = log._fs(spark, path)
        return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0

    return {r: sum(size(inc.run_path(inc.staged_path(lake, f), r)) for f in FACTS) for r in runs}


def choose(sizes: dict[int, int], fan: int = FAN, unit: int = UNIT) -> list[list[int]]:
    """The runs to merge, each list into one: the lowest tier with ``fan`` runs first, until no tier has so many.

    Tier 0 holds runs below ``unit`` bytes, each other one runs up to ``fan`` times those below it.
    """
    if fan < 2:
        raise ValueError("fan must be 2 or more")
    held = [((r,), b) for r, b in sorted(sizes.items())]
    while True:
        tiers: dict[int, list] = {}
        for x in held:
            tiers.setdefault(0 if x[1] < unit else 1 + int(math.log(x[1] / unit, fan)), []).append(x)
        full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan), None)
        if full is None:
            return [sorted(members) for members, _ in held if len(members) > 1]
        held = [x for x in held if x not in full]
        held.append((tuple(r for members, _ in full for r in members), sum(b for _, b in full)))


def staged_schema(version: log.Version, fact: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(version.schemas[f"staged/{fact}"]))


def read_staged_zone(spark: SparkSession, conf: MedallionConfig, version: log.Version | None = None) -> dict[str, DataFrame]:
    """The staged facts of one version of a lake, by default the latest."""
    lake = conf.lake_dir.rstrip("/")
    version = version or log.latest(spark, lake)
    return {name: inc.read_staged(spark, lake, fact, staged_schema(version, name), version.runs).drop(inc.RUN, inc.ARRIVED)
            for name, fact in facts(conf, None).items()}


def _merge(spark: SparkSession, lake: str, fact: inc.Fact, schema: T.StructType, runs: Sequence[int], merged: Sequence[int],
           all_merged: Sequence[int], run: int) -> None:
    """Write one fact's rows, marks and rejects of the ``merged`` runs as those of ``run``."""
    def mine(df: DataFrame) -> DataFrame:
        return df.filter(F.col(inc.RUN).isin(list(merged)))            # prunes the other runs' folders

    def marks() -> DataFrame:
        table = inc.reject_path(lake, fact.name, "superseded")
        rows = inc.read_runs(spark, table, inc.superseded_schema(schema, fact), merged).drop(inc.RUN)
        return rows.filter(~F.col("_of").isin(list(all_merged)) & F.col("_of").isin(list(runs)))

    def rejects() -> DataFrame:
        table = inc.reject_path(lake, fact.name, "rejects")
        return spark.read.option("mergeSchema", True).parquet(*[inc.run_path(table, r) for r in merged])

    live = mine(inc.read_staged(spark, lake, fact, schema, runs)).drop(inc.RUN)
    together(lambda: inc.write_run(live, inc.staged_path(lake, fact.name), run, [fact.partition_by]),
             lambda: inc.write_run(marks(), inc.reject_path(lake, fact.name, "superseded"), run),
             lambda: inc.write_run(rejects(), inc.reject_path(lake, fact.name, "rejects"), run))


def compact(spark: SparkSession, conf: MedallionConfig, fan: int = FAN, unit: int = UNIT) -> log.Version:
    """Merge the lake's small runs; the version that holds then (the old one if there is nothing to merge).

    Raises ``ConcurrentRunError`` if a run committed in the meantime; nothing has changed then.
    """
    lake = conf.lake_dir.rstrip("/")
    before = log.latest(spark, lake)
    groups = choose(run_bytes(spark, lake, before.runs[:-1]), fan, unit)
    if not groups:
        return before
    every = [r for g in groups for r in g]
    new_runs, todo = {}, []
    for group in groups:
        run = new_runs[group[0]] = log.take_run(spark, lake)
        for name, fact in facts(conf, None).items():
            todo.append(partial(_merge, spark, lake, fact, staged_schema(before, name), before.runs, group, every, run))
        read = log.arrivals(spark, lake, group)
        todo.append(partial(_copy_arrivals, read, lake, run))
    together(*todo)
    runs = tuple(new_runs.get(r, r) for r in before.runs if r in new_runs or r not in every)
    new = replace(before, version=before.version + 1, mode="compaction", runs=runs)
    log.commit(spark, lake, new)
    forget(spark, conf, before, new)
    return new


def _copy_arrivals(read: DataFrame, lake: str, run: int) -> None:
    read.coalesce(1).write.mode("overwrite").parquet(f"{lake}/_arrivals/_run={run}")
