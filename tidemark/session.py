"""Session construction and shared-storage scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every tidemark job relies on: UTC so that date arithmetic is
# reproducible, AQE so that partition counts, join strategies and skewed
# partitions are re-planned from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(total_cores: int, input_tb: float = 100.0, max_partitions: int = 400_000) -> dict:
    """Starting configuration for a large cluster (tune from the event log).

    Shuffle partitions start high (at least 4 per core, up to one per
    256 MB of input; ``max_partitions`` bounds the map-output bookkeeping of
    the driver and should only be lowered with partitions that still fit a
    task) and AQE coalesces small ones and splits skewed ones at runtime;
    scans use 256 MB splits; the broadcast threshold stays at a fixed, small
    size, so a table is only broadcast when its measured size is under it;
    runtime Bloom filters prune the large side of selective joins; stream
    state (the 24 h dedupe window) lives in RocksDB with changelog
    checkpoints; tasks and stages retry more often, for lost executors.
    """
    by_size = int(input_tb * 1024 * 1024 / 256)
    parts = max(total_cores * 4, min(by_size, max_partitions))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.task.maxFailures": "8",
        "spark.stage.maxConsecutiveAttempts": "8",
    }


def get_session(master: str | None = None, app_name: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with tidemark's base configuration."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a path on a
    shared file system), as read from the session. Only when the session
    leaves it unset (local tests) is a private temporary folder created and
    registered as the context's checkpoint directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 (a Spark Connect session has no SparkContext)
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session") from e
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; "
                           "only a local master may use a private one")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever file system ``path`` names (nothing if absent)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def make_path(spark: SparkSession, path: str) -> None:
    """Create a folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder within its file system."""
    jvm = spark.sparkContext._jvm
    p, q = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(to)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(p, q):
        raise IOError(f"{path} could not be moved to {to}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def workers_find_package(spark: SparkSession) -> None:
    """Let the Python workers of a local master import the package wherever the driver was started.

    On a cluster it is shipped with ``--py-files``.
    """
    if not spark.sparkContext.master.startswith("local"):
        return
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[1])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def together(*jobs: Callable) -> list:
    """Run independent jobs at the same time from threads of the driver; their results in order.

    The tail of one job then leaves no core idle. An error of any is raised once all have ended.
    """
    if len(jobs) < 2:
        return [job() for job in jobs]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]
