"""Metric roll-ups (R6), threshold alarms over periods (R4), stream lag.

A metric series is a DataFrame of (metric, ts, value). Everything is a
windowed aggregation (``groupBy(window(ts, period))``) plus, for alarms, a
trailing window over the periods of one metric. The period grid per metric
grows with the time span covered, never with the number of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import (STREAM_LAG_EVALUATION_PERIODS, STREAM_LAG_PERIOD_SECONDS,
                             STREAM_LAG_THRESHOLD_MS, AlarmSpec)
from tidemark.functions.scalar import half_up_ratio

VALUE_SCALE = 6   # values are aggregated exactly in units of 10^-6


def number(value: str) -> Column:
    """The value as a double; NULL, NaN and infinities are all missing."""
    v = F.col(value).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v)


def exact(value: str) -> Column:
    """The value as a decimal with 6 places, NULL when missing or of 1e22 and more.

    28 digits leave room for 10^10 rows of any size in a 38-digit sum.
    """
    return number(value).try_cast("decimal(28,6)")


def rollup(series: DataFrame, period_seconds: int, group_cols: Sequence[str] = ("metric",),
           ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """(group..., period_start, period_end, samples, sum, max, min, avg) per period.

    Sums and averages are exact (decimals with 6 places); the average is rounded
    half-up to 6 places. NULL, NaN and infinite values are missing everywhere;
    values of 1e22 and more count as samples and for max and min, but not for sum and avg.
    """
    w = F.window(F.col(ts_col), f"{period_seconds} seconds")
    v, d = number(value_col), exact(value_col)
    agg = series.groupBy(*group_cols, w.alias("_w")).agg(
        F.count(v).alias("samples"), F.sum(d).alias("_sum"), F.count(d).alias("_n"),
        F.max(v).alias("max"), F.min(v).alias("min"))
    return agg.select(
        *group_cols, F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"),
        "samples", F.col("_sum").cast("double").alias("sum"), "max", "min",
        _mean(F.col("_sum"), F.col("_n")).alias("avg"))


def _mean(total: Column, n: Column) -> Column:
    """total / n, half-up to 6 places, as a double (NULL for n = 0)."""
    units = (total * F.lit(10 ** VALUE_SCALE)).cast("decimal(38,0)")
    return half_up_ratio(units, n, 0) / F.lit(float(10 ** VALUE_SCALE))


def _statistic(name: str, value_col: str) -> Column:
    v, d = number(value_col), exact(value_col)
    if name == "sum":
        return F.sum(d).cast("double")
    if name == "max":
        return F.max(v)
    if name == "min":
        return F.min(v)
    if name == "count":
        return F.count(v).cast("double")
    if name == "avg":
        return _mean(F.sum(d), F.count(d))
    raise ValueError(f"unknown statistic {name!r}")


def _compare(stat: Column, op: str, threshold: float) -> Column:
    t = F.lit(float(threshold))
    return {">": stat > t, ">=": stat >= t, "<": stat < t, "<=": stat <= t}[op]


def period_stats(series: DataFrame, spec: AlarmSpec, metric_col: str = "metric",
                 ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """(metric, period_start, stat_value): the alarm statistic per period."""
    w = F.window(F.col(ts_col), f"{spec.period_seconds} seconds")
    return series.groupBy(F.col(metric_col).alias("metric"), w.alias("_w")) \
        .agg(_statistic(spec.statistic, value_col).alias("stat_value")) \
        .select("metric", F.col("_w.start").alias("period_start"), "stat_value")


def metric_alarm(series: DataFrame, spec: AlarmSpec, metric_col: str = "metric",
                 ts_col: str = "ts", value_col: str = "value") -> DataFrame:
    """(metric, period_start, stat_value, breaching, state) per evaluated period."""
    return evaluate_periods(period_stats(series, spec, metric_col, ts_col, value_col), spec)


def evaluate_periods(stats: DataFrame, spec: AlarmSpec) -> DataFrame:
    """Alarm states from (metric, period_start, stat_value), one row per period with data.

    ``state`` is ALARM when the last ``evaluation_periods`` periods all breach.
    Missing periods (no data): ``notBreaching`` / ``breaching`` fill a dense
    period grid per metric with a non-breaching / breaching point;
    ``missing`` / ``ignore`` evaluate only the periods that have data. The grid, and what
    one task holds of a metric, grow with the time between its first and last period:
    a stray timestamp decades off makes millions of periods, so filter the series
    to the time range in question.
    """
    if spec.treat_missing in ("notBreaching", "breaching"):
        step = F.expr(f"INTERVAL {spec.period_seconds} SECONDS")
        bounds = stats.groupBy("metric").agg(F.min("period_start").alias("_lo"),
                                             F.max("period_start").alias("_hi"))
        grid = bounds.select("metric", F.explode(F.sequence("_lo", "_hi", step)).alias("period_start"))
        stats = grid.join(stats, ["metric", "period_start"], "left")
        missing_breach = F.lit(spec.treat_missing == "breaching")
    else:
        missing_breach = F.lit(False)
    breach = F.when(F.col("stat_value").isNull(), missing_breach) \
        .otherwise(_compare(F.col("stat_value"), spec.comparison, spec.threshold))
    n = spec.evaluation_periods
    w = Window.partitionBy("metric").orderBy("period_start").rowsBetween(-(n - 1), 0)
    run = F.sum(F.when(F.col("breaching"), 1).otherwise(0)).over(w)
    size = F.count(F.lit(1)).over(w)
    return stats.withColumn("breaching", breach) \
        .withColumn("state", F.when((run == F.lit(n)) & (size == F.lit(n)), "ALARM").otherwise("OK"))


# ----- alarms without a period grid --------------------------------------------------

BLOCK = 1 << 16                     # periods of a metric that one task evaluates
CARRY = "metric string, last bigint, reset bigint, n bigint"


def alarm_intervals(stats: DataFrame, spec: AlarmSpec, carry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Alarm states over the periods there are, without making the missing ones.

    Returns (intervals, carry). ``intervals`` has (metric, period_start, periods, stat_value, breaching, state): one row per
    period with data, and for the missing periods before it one row (or two, if the state changes within them).
    ``carry`` has one row per metric, all that a later call needs to go on from here.

    A period's run of breaches is its number less that of the last reset, and the last reset is a running maximum. It is
    taken in blocks of ``BLOCK`` period numbers and then over one row per block, so a metric with very many
    periods is many tasks, and a stray timestamp is one row, however far off it is.
    """
    missing = spec.treat_missing if spec.treat_missing in ("notBreaching", "breaching") else "missing"
    start = F.col("period_start")
    micros, length = F.unix_micros(start.cast("timestamp")), spec.period_seconds * 1_000_000
    breach = F.coalesce(_compare(F.col("stat_value"), spec.comparison, spec.threshold), F.lit(missing == "breaching"))
    rows = stats.select(F.col("metric").cast("string").alias("metric"), "period_start", "stat_value", breach.alias("breaching"),
                        F.floor(micros / F.lit(length)).alias("k")).withColumn("block", F.floor(F.col("k") / F.lit(BLOCK)))
    own = Window.partitionBy("metric", "block").orderBy("k")
    rows = rows.withColumns({"before": F.lag("k").over(own), "at": F.row_number().over(own).cast("long")})
    # Per block: where it ends, how many rows, and its last reset (in rows of the block if missing periods are ignored).
    place = F.col("at") if missing == "missing" else F.col("k")
    after_gap = F.col("k") > F.col("before") + 1
    reset = F.when(~F.col("breaching"), place)
    if missing == "notBreaching":
        reset = reset.when(after_gap, F.col("k") - 1)
    rows = rows.withColumn("reset", F.max(reset).over(own))
    blocks = rows.groupBy("metric", "block").agg(F.min("k").alias("first"), F.max("k").alias("last"), F.max("reset").alias("reset"),
                                                 F.count(F.lit(1)).alias("n"))
    if carry is not None:
        # what came before is a block before all others
        blocks = blocks.unionByName(carry.select("metric", F.lit(None).cast("long").alias("block"), F.col("last").alias("first"), "last",
                                                 "reset", "n"))
    # One row per block and metric.
    order = Window.partitionBy("metric").orderBy(F.asc_nulls_first("block"))
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({"seen": F.coalesce(F.sum("n").over(past), F.lit(0)), "ended": F.max("last").over(past)})
    base = F.when(F.col("block").isNull(), F.col("reset"))
    if missing == "missing":
        whole = F.coalesce(base, F.col("seen") + F.col("reset"))
    elif missing == "breaching":
        # the first period of a metric is preceded by nothing
        whole = F.coalesce(base, F.when(F.col("ended").isNull(), F.greatest("reset", F.col("first") - 1)).otherwise(F.col("reset")))
    else:
        gap = F.when(F.col("ended").isNull() | (F.col("first") > F.col("ended") + 1), F.col("first") - 1)
        whole = F.coalesce(base, F.greatest("reset", gap))
    blocks = blocks.withColumn("whole", whole)
    blocks = blocks.withColumn("brought", F.max("whole").over(past))
    outside = blocks.filter(F.col("block").isNotNull()).select("metric", "block", "first", "seen", "ended", "brought")
    joined = rows.join(outside, ["metric", "block"])
    place = (F.col("seen") + F.col("at")) if missing == "missing" else F.col("k")
    prior = F.coalesce("before", "ended")
    start_reset = F.when(F.col("ended").isNull(), F.lit(0) if missing == "missing" else F.col("first") - 1)
    if missing == "notBreaching":
        start_reset = F.coalesce(start_reset, F.when(F.col("first") > F.col("ended") + 1, F.col("first") - 1))
    here = (F.col("seen") + F.col("reset")) if missing == "missing" else F.col("reset")
    last_reset = F.greatest(here, F.col("brought"), start_reset, F.lit(0) if missing == "missing" else F.lit(-2 ** 62))
    n = spec.evaluation_periods
    state = lambda run: F.when(run >= n, "ALARM").otherwise("OK")
    run = F.col("place") - F.col("last_reset")
    joined = joined.withColumns({"place": place, "last_reset": last_reset, "prior": prior})
    cell = lambda k, periods, value, breaching, s: F.struct(
        k.alias("k"), periods.cast("long").alias("periods"), value.alias("stat_value"), breaching.alias("breaching"), s.alias("state"))
    cells = [cell(F.col("k"), F.lit(1), F.col("stat_value"), F.col("breaching"), state(run))]
    none = F.lit(None).cast("double")
    missed = F.col("k") - F.col("prior") - 1
    if missing == "notBreaching":
        cells.append(cell(F.col("prior") + 1, missed, none, F.lit(False), F.lit("OK")))
    elif missing == "breaching":
        # The run that the gap goes on with: as long as the last period's before it.
        earlier = F.col("prior") - F.col("gap_reset")
        quiet = F.greatest(F.lit(0), F.least(missed, F.lit(n - 1) - earlier))
        # a breaching period after the gap has the same last reset; one that does not breach resets itself
        by_metric = Window.partitionBy("metric", "block").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        joined = joined.withColumn("gap_reset", F.greatest(F.max("reset").over(by_metric), F.col("brought"), start_reset, F.lit(-2 ** 62)))
        cells += [cell(F.col("prior") + 1, quiet, none, F.lit(True), F.lit("OK")),
                  cell(F.col("prior") + 1 + quiet, missed - quiet, none, F.lit(True), F.lit("ALARM"))]
    out = joined.select("metric", F.inline(F.filter(F.array(*cells), lambda c: F.coalesce(c["periods"] > 0, F.lit(False)))))
    time = F.timestamp_micros(F.col("k") * length)
    kind = dict(stats.dtypes)["period_start"]
    out = out.select("metric", time.cast(kind).alias("period_start"), "periods", "stat_value", "breaching", "state")
    ends = blocks.groupBy("metric").agg(F.max("last").alias("last"), F.max("whole").alias("reset"), F.sum("n").cast("long").alias("n"))
    return out, ends


def silent_states(carry: DataFrame, spec: AlarmSpec, until: Column | str) -> DataFrame:
    """(metric, silent_periods, state) at a time: what the whole periods without data since a metric's last one make of its state."""
    until = F.lit(until).cast("timestamp") if isinstance(until, str) else until
    now = F.floor(F.unix_micros(until) / F.lit(spec.period_seconds * 1_000_000))       # the period that is not over yet
    silent = F.greatest(now - 1 - F.col("last"), F.lit(0))
    ignored = spec.treat_missing not in ("notBreaching", "breaching")
    run = F.coalesce((F.col("n") if ignored else F.col("last")) - F.coalesce("reset", F.lit(0)), F.lit(0))
    if spec.treat_missing == "breaching":
        run = run + silent
    elif spec.treat_missing == "notBreaching":
        run = F.when(silent > 0, 0).otherwise(run)
    return carry.select("metric", silent.cast("long").alias("silent_periods"),
                        F.when(run >= spec.evaluation_periods, "ALARM").otherwise("OK").alias("state"))


def stream_lag(df: DataFrame, arrival_col: str = "_ingested_ts", event_col: str = "event_ts",
               metric: str = "stream_lag_ms") -> DataFrame:
    """A lag series (metric, ts, value): arrival time − event time in milliseconds."""
    lag = F.timestamp_diff("MILLISECOND", F.col(event_col).cast("timestamp"),
                           F.col(arrival_col).cast("timestamp"))
    return df.select(F.lit(metric).alias("metric"), F.col(arrival_col).alias("ts"),
                     lag.cast("double").alias("value"))


def stream_lag_alarm(df: DataFrame, arrival_col: str = "_ingested_ts",
                     event_col: str = "event_ts") -> DataFrame:
    """Lag alarm: max lag per 5 minutes above 60 s for 2 consecutive periods."""
    spec = AlarmSpec("stream_lag", "max", STREAM_LAG_PERIOD_SECONDS, float(STREAM_LAG_THRESHOLD_MS),
                     STREAM_LAG_EVALUATION_PERIODS, ">", "missing")
    return metric_alarm(stream_lag(df, arrival_col, event_col), spec)


def rollup_stream(stream: DataFrame, period_seconds: int, watermark: str,
                  group_cols: Sequence[str] = ("metric",), ts_col: str = "ts",
                  value_col: str = "value") -> DataFrame:
    """``rollup`` on a stream: a period is emitted (append mode) once the
    watermark has passed its end. Events later than the watermark are left out and counted by
    ``alarms.late_rows``; ``rollup`` over the landed series is the authority."""
    ts = F.col(ts_col).cast("timestamp")
    return rollup(stream.withColumn(ts_col, ts).withWatermark(ts_col, watermark),
                  period_seconds, group_cols, ts_col, value_col)
