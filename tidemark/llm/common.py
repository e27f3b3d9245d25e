"""Helpers shared by the operators: reading, written tables, text rules."""

from __future__ import annotations

import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path

# Words are runs of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Translates A-Z only: lower-casing that keeps every offset.
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if spark.sparkContext.master.startswith("local"):
        # Python workers of this machine find the package wherever the driver was started;
        # on a cluster it is shipped with --py-files.
        env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str, codec: str = "zstd") -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder and read it back.

    This cuts the lineage with files every executor can read again, so losing
    an executor costs a re-read and not a re-computation.
    """
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
