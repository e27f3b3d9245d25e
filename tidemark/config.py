"""Fixed values.

Everything in the first block must equal the reference behaviour for the
results to agree: the funnel stages and their order, the default
data-quality thresholds, the standard suite, the storage
lifecycle rules, the storage prices and the alarm definitions.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference's)
# ---------------------------------------------------------------------------

# Funnel stages, in order. remove_from_cart is an event type outside the funnel.
FUNNEL_STAGES = ("page_view", "product_view", "add_to_cart", "checkout_start", "purchase")
COMPLETED_STATUS = "completed"

# conversion_rate = purchase / product_view, rounded to 4 places; spend to 2.
CONVERSION_NUMERATOR = "purchase"
CONVERSION_DENOMINATOR = "product_view"
RATE_SCALE = 4
MONEY_SCALE = 2

# Data-quality defaults: completeness 0.98, uniqueness 0.999,
# referential integrity 0.99, freshness 7 days; scores rounded to 4 places.
DQ_COMPLETENESS_THRESHOLD = 0.98
DQ_UNIQUENESS_THRESHOLD = 0.999
DQ_REFERENTIAL_THRESHOLD = 0.99
DQ_FRESHNESS_MAX_AGE_DAYS = 7
DQ_SCORE_SCALE = 4

# Data-quality result texts: check names, statuses and detail formats.
# Counts are written with thousands separators; column lists as Python lists.
DQ_COMPLETENESS = "completeness"
DQ_UNIQUENESS = "uniqueness"
DQ_REFERENTIAL = "referential_integrity"
DQ_FRESHNESS = "freshness"
DQ_PASS = "PASS"
DQ_FAIL = "FAIL"
DQ_DETAIL_COMPLETENESS = "{part}/{total} rows complete across {columns}"
DQ_DETAIL_UNIQUENESS = "{part}/{total} unique values for {key}"
DQ_DETAIL_REFERENTIAL = "{part}/{total} rows have a valid {column} reference"
DQ_DETAIL_FRESHNESS = "Latest record is {age} days old (max allowed: {max_age})"
DQ_DETAIL_EMPTY = "Table is empty"

# Storage lifecycle per zone: (minimum age in days, storage class), ascending.
# raw: STANDARD, STANDARD_IA after 30 days, GLACIER after 90, expired after 1825.
# staged: STANDARD, STANDARD_IA after 60 days. curated: always STANDARD.
LIFECYCLE_RULES = {
    "raw": ((0, "STANDARD"), (30, "STANDARD_IA"), (90, "GLACIER"), (1825, "EXPIRED")),
    "staged": ((0, "STANDARD"), (60, "STANDARD_IA")),
    "curated": ((0, "STANDARD"),),
}

# Storage prices, USD per GB-month (expired objects cost nothing).
STORAGE_PRICE_GB_MONTH = {
    "STANDARD": 0.025,
    "STANDARD_IA": 0.0138,
    "GLACIER": 0.0045,
    "EXPIRED": 0.0,
}


@dataclass(frozen=True)
class AlarmSpec:
    """A metric alarm: statistic over fixed periods compared with a threshold."""

    name: str
    statistic: str            # "sum" | "max" | "avg" | "count" | "min"
    period_seconds: int
    threshold: float
    evaluation_periods: int = 1
    comparison: str = ">"     # ">" | ">=" | "<" | "<="
    treat_missing: str = "missing"  # "missing" | "ignore" | "notBreaching" | "breaching"

    def __post_init__(self):
        if self.treat_missing not in ("missing", "ignore", "notBreaching", "breaching"):
            raise ValueError(f"unknown treat_missing {self.treat_missing!r}")
        if self.comparison not in (">", ">=", "<", "<="):
            raise ValueError(f"unknown comparison {self.comparison!r}")
        if self.evaluation_periods < 1 or self.period_seconds < 1:
            raise ValueError("evaluation_periods and period_seconds must be positive")


# Alarm definitions: failures (sum over 5 min > 0), consumer lag (max over
# 5 min > 60000 ms, 2 periods), compute capacity (max over 15 min > 64).
ALARMS = (
    AlarmSpec("execution_failed", "sum", 300, 0.0, 1, ">", "missing"),
    AlarmSpec("job_failed_tasks", "sum", 300, 0.0, 1, ">", "notBreaching"),
    AlarmSpec("consumer_lag", "max", 300, 60000.0, 2, ">", "missing"),
    AlarmSpec("compute_capacity", "max", 900, 64.0, 1, ">", "notBreaching"),
)
STREAM_LAG_THRESHOLD_MS = 60000
STREAM_LAG_PERIOD_SECONDS = 300
STREAM_LAG_EVALUATION_PERIODS = 2

# Micro-batch bound of the stream consumer: 500 records or 30 seconds.
STREAM_MAX_RECORDS_PER_BATCH = 500
STREAM_BATCH_WINDOW_SECONDS = 30
# Stream retention, used as the event-time watermark for stream dedupe.
STREAM_RETENTION = "24 hours"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FunnelSpec:
    """Which event types form the funnel and which two define conversion."""

    stages: tuple = FUNNEL_STAGES
    numerator: str = CONVERSION_NUMERATOR
    denominator: str = CONVERSION_DENOMINATOR

    def __post_init__(self):
        for s in (self.numerator, self.denominator):
            if s not in self.stages:
                raise ValueError(f"conversion stage {s!r} is not a funnel stage")


DEFAULT_FUNNEL = FunnelSpec()
