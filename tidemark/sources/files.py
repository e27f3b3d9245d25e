"""File scans and sinks (S1–S5, S8, S9, K1–K4, K6, P1, A5) and schema drift.

Counts of written rows come from an ``Observation`` attached to the write,
so no second job re-reads the data to count it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_text_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """All-text CSV scan with a header (no inference pass, no type errors); no paths give no rows."""
    if not path:
        return spark.createDataFrame([], text_schema(columns))
    return spark.read.option("header", True).option("mode", "PERMISSIVE") \
        .schema(text_schema(columns)).csv(path)


def read_table(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
               columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a zone table (Parquet by default); ``columns`` prunes the scan."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def read_catalog(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A table or view of the session's catalog (``table`` or ``database.table``)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def stamp_ingest(df: DataFrame, col: str = "_ingested_ts") -> DataFrame:
    return df.withColumn(col, F.current_timestamp())


def spread_by(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows dealt by their partition values before a partitioned write (REBALANCE).

    AQE then splits the value that holds most rows over many tasks and merges
    small ones, so a table gets neither one huge task nor tasks x values small files.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), header: bool = True,
                observe: bool = True) -> int | None:
    """Write ``df``; return the number of rows written (observed during the write).

    With ``partition_by`` rows are rebalanced by the partition columns first
    (``spread_by``).
    """
    df = spread_by(df, partition_by)
    obs = Observation("rows") if observe else None
    if obs is not None:
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    # an overwrite replaces the whole table (also partitions that vanished),
    # whatever the session's partitionOverwriteMode says
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"]) if obs is not None else None


def ingest_raw(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Raw zone landing: every value as text plus ``_ingested_ts``; row count.

    ``mode="append"`` lands a new drop next to the earlier ones (new files only).
    """
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    return write_table(stamp_ingest(text), path, mode=mode, fmt=fmt)


def union_sources(*frames: DataFrame) -> DataFrame:
    """One table from several arrival paths: union by column name, absent columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def register_zone(spark: SparkSession, zone_path: str, tables: Sequence[str],
                  fmt: str = "parquet", prefix: str = "") -> list[str]:
    """Expose zone tables to ``spark.sql`` in place (temporary views, no copy)."""
    names = []
    for t in tables:
        spark.read.format(fmt).load(f"{zone_path}/{t}").createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names


# ----- schema drift (R1) -----------------------------------------------------

DRIFT_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("change", T.StringType(), False),
    T.StructField("known_type", T.StringType(), True),
    T.StructField("new_type", T.StringType(), True),
])


def schema_drift(spark: SparkSession, known: T.StructType, new: T.StructType) -> DataFrame:
    """Drift report between a known schema and a newly arrived one.

    ``added`` (new column), ``missing`` (known column absent from the new
    data — reported, never deleted) and ``type_changed``. Built from the two
    schemas only (metadata, one row per column).
    """
    k = {f.name: f.dataType.simpleString() for f in known.fields}
    n = {f.name: f.dataType.simpleString() for f in new.fields}
    rows = [(c, "added", None, n[c]) for c in n if c not in k]
    rows += [(c, "missing", k[c], None) for c in k if c not in n]
    rows += [(c, "type_changed", k[c], n[c]) for c in k if c in n and k[c] != n[c]]
    return spark.createDataFrame(rows, DRIFT_SCHEMA)


def merge_drifted(known: DataFrame, *new: DataFrame) -> DataFrame:
    """Union under drift: new columns added, vanished ones kept as NULL, changed types widened.

    Each column gets the least type that holds the values of all frames (``common_types``); what a value loses on the
    way there is in ``drift_losses``.
    """
    types = common_types([known, *new])
    out = None
    for df in (known, *new):
        same = df.select(*[_as_type(F.col(f"`{f.name}`"), f.dataType, types[f.name]).alias(f.name) for f in df.schema.fields])
        out = same if out is None else out.unionByName(same, allowMissingColumns=True)
    return out


_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}       # type -> decimal digits, in widening order


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that values of both fit: whole numbers < decimals < floating point; dates < timestamps; else text.

    A decimal that would need more than 38 digits becomes a double. Types of different kinds, and nested
    types that differ, meet in text. The order of arguments and of merging does not matter.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    x, y = a.simpleString(), b.simpleString()
    whole, real = list(_WHOLE), (T.FloatType, T.DoubleType)
    numbers = [x in _WHOLE or isinstance(t, (T.DecimalType, *real)) for t, x in ((a, x), (b, y))]
    if x in _WHOLE and y in _WHOLE:
        return a if whole.index(x) > whole.index(y) else b
    if all(numbers):
        if isinstance(a, real) or isinstance(b, real):
            return T.DoubleType()
        (p, s), (q, t) = [(d.precision, d.scale) if isinstance(d, T.DecimalType) else (_WHOLE[n], 0) for d, n in ((a, x), (b, y))]
        scale = max(s, t)
        digits = max(p - s, q - t) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return a if times.index(type(a)) > times.index(type(b)) else b
    return T.StringType()


def common_types(frames: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """Column -> its type over all frames, from the schemas alone."""
    out: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            out[f.name] = common_type(out[f.name], f.dataType) if f.name in out else f.dataType
    return out


def _as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast(want)


LOSSES = "column string, from_type string, to_type string, value string, rows long"


def drift_losses(spark: SparkSession, *frames: DataFrame) -> DataFrame:
    """(column, from_type, to_type, value, rows): the values that do not survive the way to the merged type and back.

    Only widening into floating point and from a decimal can lose digits, so only such columns are looked at,
    all of a frame in one pass.
    """
    types, out = common_types(frames), None
    for df in frames:
        cells = []
        for f in df.schema.fields:
            have, want = f.dataType, types[f.name]
            if have == want or not isinstance(want, T.DoubleType) or isinstance(have, T.FloatType):
                continue
            c = F.col(f"`{f.name}`")
            exact = "decimal(38,18)" if isinstance(have, T.DecimalType) else "decimal(38,0)"
            lost = F.coalesce(c.cast(want).try_cast(exact) != c.try_cast(exact), c.isNotNull())
            cells.append(F.struct(F.lit(f.name).alias("column"), F.lit(have.simpleString()).alias("from_type"),
                                  F.lit(want.simpleString()).alias("to_type"), c.cast("string").alias("value"), lost.alias("lost")))
        if cells:
            rows = df.select(F.inline(F.filter(F.array(*cells), lambda x: x["lost"]))) \
                .groupBy("column", "from_type", "to_type", "value").agg(F.count(F.lit(1)).alias("rows"))
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], LOSSES)
    # a value may come from several frames of one type
    return out.groupBy("column", "from_type", "to_type", "value").agg(F.sum("rows").alias("rows"))


def read_merged(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Read Parquet files written under different schemas as one table."""
    return spark.read.option("mergeSchema", True).parquet(*paths)
