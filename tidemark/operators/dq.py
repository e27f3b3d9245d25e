"""Data-quality checks: completeness, uniqueness, referential integrity, freshness.

Every check returns a one-row DataFrame with the fixed ``DQ_SCHEMA``; a suite
is their union. Scores are part/total (0 on an empty table), the status is
decided on the unrounded score, the reported metric is rounded half-up to 4
places exactly. Each check is one aggregation job over its table; the only
driver-side step is the gate, which reads the handful of result rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import (DQ_COMPLETENESS, DQ_COMPLETENESS_THRESHOLD, DQ_DETAIL_COMPLETENESS,
                             DQ_DETAIL_EMPTY, DQ_DETAIL_FRESHNESS, DQ_DETAIL_REFERENTIAL,
                             DQ_DETAIL_UNIQUENESS, DQ_FAIL, DQ_FRESHNESS,
                             DQ_FRESHNESS_MAX_AGE_DAYS, DQ_PASS, DQ_REFERENTIAL,
                             DQ_REFERENTIAL_THRESHOLD, DQ_SCORE_SCALE, DQ_UNIQUENESS,
                             DQ_UNIQUENESS_THRESHOLD)
from tidemark.functions.scalar import floor_days_between, half_up_ratio, thousands

DQ_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType(), False),
    T.StructField("table", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("metric_value", T.DoubleType(), True),
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("detail", T.StringType(), False),
    T.StructField("run_ts", T.TimestampNTZType(), False),
])


class DataQualityError(RuntimeError):
    """Raised by the gate when any check failed; curated data is not published."""

    def __init__(self, failed_rows):
        self.failed = failed_rows
        names = ", ".join(f"{r['table']}.{r['check_name']}" for r in failed_rows)
        super().__init__(f"{len(failed_rows)} data-quality check(s) failed: {names}")


def _run_ts(as_of) -> Column:
    if as_of is None:
        return F.localtimestamp()
    return F.lit(as_of).cast("timestamp_ntz") if not isinstance(as_of, Column) else as_of.cast("timestamp_ntz")


def _py_list(cols: Sequence[str]) -> str:
    return "[" + ", ".join(repr(c) for c in cols) + "]"


def _render(template: str, **parts) -> Column:
    """Fill ``{name}`` placeholders of a fixed text with Columns or plain text."""
    pieces = []
    for i, chunk in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2 == 0:
            if chunk:
                pieces.append(F.lit(chunk))
        else:
            v = parts[chunk]
            pieces.append(v if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*pieces)


def _result_cols(name: str, table: str, part: str, total: str, threshold: float,
                 detail: Column, as_of) -> list[Column]:
    """The result fields of a ratio check from aggregated ``part`` / ``total`` columns."""
    score = F.when(F.col(total) > 0, F.col(part) / F.col(total)).otherwise(F.lit(0.0))
    metric = F.coalesce(half_up_ratio(part, total, DQ_SCORE_SCALE), F.lit(0.0))
    return [F.lit(name).alias("check_name"), F.lit(table).alias("table"),
            F.when(score >= F.lit(float(threshold)), DQ_PASS).otherwise(DQ_FAIL).alias("status"),
            metric.alias("metric_value"), F.lit(float(threshold)).alias("threshold"),
            detail.alias("detail"), _run_ts(as_of).alias("run_ts")]


def _all_present(df: DataFrame, required_cols: Sequence[str]) -> Column:
    if not required_cols:
        raise ValueError("completeness needs at least one required column")
    types = dict(df.dtypes)
    out = None
    for c in required_cols:
        ok = F.col(c).isNotNull()
        if types.get(c) in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        out = ok if out is None else out & ok
    return out


def _keys(key_col) -> list[str]:
    return [key_col] if isinstance(key_col, str) else list(key_col)


def _latest(df: DataFrame, date_col: str) -> Column:
    c = F.col(date_col)
    parsed = c.cast("string").try_cast("timestamp_ntz") if dict(df.dtypes).get(date_col) == "string" \
        else c.cast("timestamp_ntz")
    return F.max(parsed)


# Per-kind: aggregate expressions over the table, and result fields over the
# aggregated row. ``p`` is a unique column prefix; ``_total`` is the row count.

def _completeness_aggs(df, p, required_cols):
    return [F.count_if(_all_present(df, required_cols)).alias(f"{p}part")]


def _completeness_row(p, table, required_cols, threshold, as_of):
    detail = _render(DQ_DETAIL_COMPLETENESS, part=thousands(f"{p}part"), total=thousands("_total"),
                     columns=_py_list(required_cols))
    return _result_cols(DQ_COMPLETENESS, table, f"{p}part", "_total", threshold, detail, as_of)


def _uniqueness_aggs(df, p, key_col):
    return [F.count_distinct(*[F.col(k) for k in _keys(key_col)]).alias(f"{p}part")]


def _uniqueness_row(p, table, key_col, threshold, as_of):
    keys = _keys(key_col)
    label = keys[0] if len(keys) == 1 else _py_list(keys)
    detail = _render(DQ_DETAIL_UNIQUENESS, part=thousands(f"{p}part"), total=thousands("_total"),
                     key=label)
    return _result_cols(DQ_UNIQUENESS, table, f"{p}part", "_total", threshold, detail, as_of)


def _freshness_aggs(df, p, date_col):
    return [_latest(df, date_col).alias(f"{p}latest")]


def _freshness_row(p, table, date_col, max_age_days, as_of):
    now = _run_ts(as_of)
    latest = F.col(f"{p}latest")
    age = floor_days_between(latest, now)
    empty = F.col("_total") == 0
    status = F.when(~empty & latest.isNotNull() & (age <= F.lit(max_age_days)), DQ_PASS) \
        .otherwise(DQ_FAIL)
    detail = F.when(empty, F.lit(DQ_DETAIL_EMPTY)) \
        .when(latest.isNull(), F.lit(f"No valid {date_col} values")) \
        .otherwise(_render(DQ_DETAIL_FRESHNESS, age=age.cast("string"), max_age=max_age_days))
    return [F.lit(DQ_FRESHNESS).alias("check_name"), F.lit(table).alias("table"),
            status.alias("status"), F.when(~empty, age.cast("double")).alias("metric_value"),
            F.lit(float(max_age_days)).alias("threshold"), detail.alias("detail"),
            now.alias("run_ts")]


def _count_all() -> Column:
    return F.count(F.lit(1))


def check_completeness(df: DataFrame, table: str, required_cols: Sequence[str],
                       threshold: float = DQ_COMPLETENESS_THRESHOLD, as_of=None) -> DataFrame:
    """Share of rows where every required column is present (NaN counts as missing)."""
    agg = df.agg(_count_all().alias("_total"), *_completeness_aggs(df, "_", required_cols))
    return agg.select(*_completeness_row("_", table, required_cols, threshold, as_of))


def check_uniqueness(df: DataFrame, table: str, key_col, threshold: float = DQ_UNIQUENESS_THRESHOLD,
                     as_of=None) -> DataFrame:
    """Distinct non-NULL keys / all rows (NULL keys lower the score).

    ``key_col`` may be a list for a composite key; a row with any NULL key
    part is not counted as a distinct value.
    """
    agg = df.agg(_count_all().alias("_total"), *_uniqueness_aggs(df, "_", key_col))
    return agg.select(*_uniqueness_row("_", table, key_col, threshold, as_of))


def check_referential_integrity(df: DataFrame, table: str, fk_col: str, valid_keys: DataFrame,
                                key_col: str | None = None,
                                threshold: float = DQ_REFERENTIAL_THRESHOLD, as_of=None) -> DataFrame:
    """Share of rows whose foreign key exists in ``valid_keys`` (NULL FK is invalid).

    The fact side is first reduced to (fk, rows) with a map-side partial
    aggregate, so a hot foreign key costs one row per map task; the parent
    side is made distinct, so duplicated parent keys never inflate counts;
    both sides are then hash-partitioned on the key and joined.
    """
    key_col = key_col or fk_col
    per_fk = df.groupBy(F.col(fk_col).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    parents = valid_keys.select(F.col(key_col).alias("_fk")).distinct() \
        .withColumn("_hit", F.lit(True))
    joined = per_fk.join(parents, "_fk", "left")
    agg = joined.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"),
                     F.coalesce(F.sum(F.when(F.col("_hit"), F.col("_n"))), F.lit(0)).alias("_part"))
    detail = _render(DQ_DETAIL_REFERENTIAL, part=thousands("_part"), total=thousands("_total"),
                     column=fk_col)
    return agg.select(*_result_cols(DQ_REFERENTIAL, table, "_part", "_total", threshold,
                                    detail, as_of))


def check_freshness(df: DataFrame, table: str, date_col: str,
                    max_age_days: int = DQ_FRESHNESS_MAX_AGE_DAYS, as_of=None) -> DataFrame:
    """Whole days since the latest ``date_col`` value, PASS when <= ``max_age_days``.

    Empty table: FAIL with a NULL metric. No parsable date at all: FAIL with
    a NULL metric. ``as_of`` fixes "now" for repeatable results.
    """
    agg = df.agg(_count_all().alias("_total"), *_freshness_aggs(df, "_", date_col))
    return agg.select(*_freshness_row("_", table, date_col, max_age_days, as_of))


@dataclass(frozen=True)
class CheckSpec:
    """Declarative description of one check in a suite."""

    kind: str                 # completeness | uniqueness | referential_integrity | freshness
    table: str
    columns: tuple = ()
    parent_table: str | None = None
    parent_key: str | None = None
    threshold: float | None = None
    options: dict = field(default_factory=dict)


def run_check(spec: CheckSpec, tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    df = tables[spec.table]
    kw = {} if spec.threshold is None else {"threshold": spec.threshold}
    if spec.kind == "completeness":
        return check_completeness(df, spec.table, list(spec.columns), as_of=as_of, **kw)
    if spec.kind == "uniqueness":
        key = spec.columns[0] if len(spec.columns) == 1 else list(spec.columns)
        return check_uniqueness(df, spec.table, key, as_of=as_of, **kw)
    if spec.kind == "referential_integrity":
        return check_referential_integrity(df, spec.table, spec.columns[0],
                                           tables[spec.parent_table], spec.parent_key,
                                           as_of=as_of, **kw)
    if spec.kind == "freshness":
        age = spec.options.get("max_age_days", DQ_FRESHNESS_MAX_AGE_DAYS)
        return check_freshness(df, spec.table, spec.columns[0], age, as_of=as_of)
    raise ValueError(f"unknown check kind {spec.kind!r}")


def _threshold(spec: "CheckSpec", default: float) -> float:
    return default if spec.threshold is None else spec.threshold


def run_table_checks(df: DataFrame, table: str, specs: Sequence["CheckSpec"], as_of=None) -> DataFrame:
    """All single-table checks of one table in ONE aggregation pass.

    Completeness counts, latest dates, the row count and one distinct count
    are computed together (a single distinct aggregate needs no row
    expansion); the result rows are unpacked from the one aggregated row.
    Only one uniqueness check may be fused; ``run_suite_specs`` runs any
    further ones as their own pass.
    """
    aggs, rows = [_count_all().alias("_total")], []
    for i, spec in enumerate(specs):
        p = f"_c{i}_"
        if spec.kind == "completeness":
            aggs += _completeness_aggs(df, p, spec.columns)
            rows.append(_completeness_row(p, table, spec.columns,
                                          _threshold(spec, DQ_COMPLETENESS_THRESHOLD), as_of))
        elif spec.kind == "uniqueness":
            key = spec.columns[0] if len(spec.columns) == 1 else list(spec.columns)
            aggs += _uniqueness_aggs(df, p, key)
            rows.append(_uniqueness_row(p, table, key, _threshold(spec, DQ_UNIQUENESS_THRESHOLD), as_of))
        elif spec.kind == "freshness":
            age = spec.options.get("max_age_days", DQ_FRESHNESS_MAX_AGE_DAYS)
            aggs += _freshness_aggs(df, p, spec.columns[0])
            rows.append(_freshness_row(p, table, spec.columns[0], age, as_of))
        else:
            raise ValueError(f"{spec.kind} cannot be fused into a table pass")
    packed = F.array(*[F.struct(*cols) for cols in rows])
    return df.agg(*aggs).select(F.explode(packed).alias("_r")).select("_r.*")


def run_suite(checks: Sequence[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(results, failed): the union of the check rows and its FAIL subset."""
    results = checks[0]
    for c in checks[1:]:
        results = results.unionByName(c)
    return results, results.filter(F.col("status") == DQ_FAIL)


def run_suite_specs(specs: Sequence[CheckSpec], tables: dict[str, DataFrame],
                    as_of=None, fused: bool = True) -> tuple[DataFrame, DataFrame]:
    """Run a suite. With ``fused`` the single-table checks of each table share
    one aggregation pass (at most one distinct count per pass); referential
    integrity checks are joins and run as their own pass."""
    if not fused:
        return run_suite([run_check(s, tables, as_of) for s in specs])
    passes: list[tuple[str, list[CheckSpec]]] = []
    separate: list[CheckSpec] = []
    for spec in specs:
        if spec.kind == "referential_integrity":
            separate.append(spec)
            continue
        placed = False
        for table, group in passes:
            has_distinct = any(g.kind == "uniqueness" for g in group)
            if table == spec.table and not (spec.kind == "uniqueness" and has_distinct):
                group.append(spec)
                placed = True
                break
        if not placed:
            passes.append((spec.table, [spec]))
    frames = [run_table_checks(tables[t], t, group, as_of) for t, group in passes]
    frames += [run_check(s, tables, as_of) for s in separate]
    return run_suite(frames)


def suite_summary(results: DataFrame) -> DataFrame:
    """(checks, failed) — one row."""
    return results.agg(F.count(F.lit(1)).alias("checks"),
                       F.count_if(F.col("status") == DQ_FAIL).alias("failed"))


def write_results(results: DataFrame, path: str, run_id: str) -> None:
    """Write the results of one run; a retry with the same ``run_id`` replaces its own rows only."""
    results.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/run_id={run_id}")


def gate(results: DataFrame) -> DataFrame:
    """Raise ``DataQualityError`` when any check failed; return the results.

    The result table has one row per check (a handful), so reading its FAIL
    rows on the driver is bounded by the suite size, not by data size.
    """
    failed = [r.asDict() for r in results.filter(F.col("status") == DQ_FAIL)
              .select("check_name", "table", "metric_value", "threshold").collect()]
    if failed:
        raise DataQualityError(failed)
    return results
