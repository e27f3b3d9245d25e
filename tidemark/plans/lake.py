"""The log of a lake: which runs count, which files they read, where the published tables are.

``<lake>/_log`` holds one small file per version, written by put-if-absent: what a run did becomes
visible with that file, all of it or nothing. The record of a version names

* the runs that count since the last full run (every zone keeps a partition ``_run`` per run),
* the folder of every bucket of every kept or published table (``tidemark.plans.maintained``).

The files a run has read (source, path, modification time, length) are a partition of
``<lake>/_arrivals``, written before the record; they count when their run counts, so a
file is taken once, whatever way it came and whichever mode took it, and a crash before the
commit leaves no trace. A run takes its number by put-if-absent too, so two runs at once never write to
the same place; the one that commits second fails, because its version is there already.

Readers read the latest version, or any that is kept. Replaced folders stay for ``KEEP`` more versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import delete_path

KEEP = 1
ARRIVALS = "source string, path string, modified long, length long"


class ConcurrentRunError(RuntimeError):
    """Another run has committed in the meantime."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it is absent."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False if there is one already.

    The text goes to a file of its own, which is then renamed without overwriting: atomic on file systems
    with an atomic rename, as Spark's own stream logs need them too.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    p, fs = _fs(spark, temporary)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    target = jvm.org.apache.hadoop.fs.Path(path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(p).toUri(), conf) \
            .rename(fs.makeQualified(p), fs.makeQualified(target), how)
        return True
    except Exception:  # noqa: BLE001 (a Java exception: decided by what is there)
        delete_path(spark, temporary)
        if fs.exists(target):
            return False
        raise


@dataclass(frozen=True)
class Version:
    """What a lake holds after a commit."""

    version: int = -1
    run: int = -1
    mode: str = "full"
    runs: tuple[int, ...] = ()                              # that count, oldest first
    buckets: int = 0
    # table -> bucket -> run whose folder holds it; "state/..." and "curated/..."
    tables: dict[str, dict[str, int]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)   # of those tables, as JSON
    # dimension -> bucket -> checksum of its rows
    checksums: dict[str, dict[str, str]] = field(default_factory=dict)
    rules: str = ""                                         # what state was computed by; other rules need a new one


def _version_path(lake: str, version: int) -> str:
    return f"{lake}/_log/{version:010d}.json"


def read_version(spark: SparkSession, lake: str, version: int) -> Version:
    text = spark.read.text(_version_path(lake, version), wholetext=True).first()[0]
    got = json.loads(text)
    return Version(**{**got, "runs": tuple(got["runs"])})


def latest(spark: SparkSession, lake: str) -> Version:
    """The last committed version; an empty one for a new lake."""
    found = [n for n in list_names(spark, f"{lake}/_log") if n.endswith(".json")]
    return read_version(spark, lake, int(found[-1].split(".")[0])) if found else Version()


def take_run(spark: SparkSession, lake: str) -> int:
    """A run number nobody else has."""
    taken = [int(n.split(".")[0]) for n in list_names(spark, f"{lake}/_log/runs") if n.endswith(".run")]
    run = max(taken, default=-1) + 1
    while not put_if_absent(spark, f"{lake}/_log/runs/{run:010d}.run", ""):
        run += 1
    return run


def commit(spark: SparkSession, lake: str, new: Version) -> None:
    """Make a version visible. Raises ``ConcurrentRunError`` if another one has taken its place."""
    if not put_if_absent(spark, _version_path(lake, new.version), json.dumps(asdict(new))):
        raise ConcurrentRunError(f"{lake}: version {new.version} was committed by another run")


# ----- arrivals -------------------------------------------------------------------

def arrivals(spark: SparkSession, lake: str, runs: Sequence[int]) -> DataFrame:
    """(source, path, modified, length) of every file the given runs have read."""
    paths = [f"{lake}/_arrivals/_run={r}" for r in runs]
    have = set(list_names(spark, f"{lake}/_arrivals"))
    paths = [p for p in paths if p.rsplit("/", 1)[1] in have]
    return spark.read.schema(ARRIVALS).parquet(*paths) if paths else spark.createDataFrame([], ARRIVALS)


def record_arrivals(spark: SparkSession, lake: str, run: int, files: Sequence[tuple[str, str, int, int]]) -> None:
    """Write the files of a run; they count once the run is committed."""
    if not files:
        return
    spark.createDataFrame(list(files), ARRIVALS).coalesce(1).write.mode("overwrite").parquet(f"{lake}/_arrivals/_run={run}")


@dataclass(frozen=True)
class Source:
    """Where rows of a table arrive: files below ``path``, or a file-based table of the catalog.

    ``name`` is its bookmark: a table may have several sources (batch export, landed stream).
    """

    name: str
    path: str | None = None
    fmt: str = "csv"
    table: str | None = None
    optional: bool = False           # no folder yet means no files yet


def _root(spark: SparkSession, source: Source) -> str:
    if source.path:
        return source.path
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {source.table}").filter("col_name = 'Location'").collect()
    if not rows:
        raise ValueError(f"{source.table} has no files: only file-based tables can be read by arrival")
    return rows[0]["data_type"]


def files_of(spark: SparkSession, source: Source, known: DataFrame | None = None) -> list[tuple[str, str, int, int]]:
    """(source, path, modified, length) of the source's files, but for the ``known`` arrivals.

    Files are listed as rows by Spark's tasks; only those to be read now reach the driver, which plans their
    scan. A file that was replaced under its name (other time or length) is a new arrival.
    """
    if source.optional and not list_names(spark, source.path):
        return []
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_root(spark, source)) \
        .select("path", F.unix_micros("modificationTime").alias("modified"), "length") \
        .filter(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]") & (F.col("length") > 0))
    if known is not None:
        found = found.join(known.filter(F.col("source") == source.name).drop("source"), ["path", "modified", "length"], "left_anti")
    return [(source.name, r["path"], r["modified"], r["length"]) for r in found.orderBy("path").collect()]


def read_files(spark: SparkSession, source: Source, files: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Exactly the given files of a source, as text columns; no files give no rows."""
    from tidemark.sources.files import read_text_csv, text_schema
    paths = [f[1] for f in files]
    if not paths:
        return spark.createDataFrame([], text_schema(columns))
    if source.table:
        # the file filter prunes the scan to these files; local paths have two spellings
        spelled = [*paths, *[p.replace("file:/", "file:///", 1) for p in paths if p.startswith("file:/")]]
        df = spark.table(source.table)
        return df.filter(F.col("_metadata.file_path").isin(spelled)).select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if source.fmt == "csv":
        return read_text_csv(spark, paths, columns)
    df = spark.read.format(source.fmt).load(paths)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns if not c.startswith("_")])
