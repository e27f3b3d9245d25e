"""Scalar expressions shared by the operators.

All of them are plain ``pyspark.sql.functions`` compositions, so they stay
inside whole-stage codegen. ANSI mode is on in Spark 4, so every conversion
that may fail on dirty input uses a ``try_*`` form: one bad row must never
kill a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_present(c) -> Column:
    """Not NULL and not the empty text (both forms of a missing id)."""
    c = _col(c)
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def coerce_amount(c, precision: int = 18, scale: int = 2) -> Column:
    """Lenient money parse: trimmed text → decimal, NULL when not a number.

    ``NaN`` and ``Infinity`` have no decimal form, so they become NULL and
    fail the positivity rule instead of passing it as a double NaN would.
    """
    return F.trim(_col(c).cast("string")).try_cast(f"decimal({precision},{scale})")


def coerce_quantity(c) -> Column:
    """Lenient integer parse: text → double → int (truncating), NULL otherwise.

    ``1.5`` gives 1, ``0.5`` gives 0 (then rejected by ``> 0``), numbers out of
    int range and non-finite values give NULL.
    """
    d = F.trim(_col(c).cast("string")).try_cast("double")
    finite = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    return F.when(finite, d.try_cast("int"))


def int_div(a, b) -> Column:
    """Integral division (``a div b``), exact for any long values."""
    return F.call_function("div", _col(a), _col(b))


def half_up_ratio(num, den, scale: int) -> Column:
    """``round(num / den, scale)`` with exact half-up (away from zero) rounding.

    ``num`` and ``den`` are integral columns (counts, cents). The division
    is done in integers so that ties such as x.xx5 never depend on a binary
    float representation. NULL when ``den`` is 0 or NULL. Numerators too large for
    64-bit intermediate values (about 9e18 / 10**scale) take the same steps in
    38-digit decimals.
    """
    unit = 10 ** scale
    n, d = _col(num).cast("decimal(38,0)"), _col(den).cast("decimal(38,0)")
    small = F.abs(n) < F.lit(2 ** 61 // (2 * unit))
    narrow = lambda c: F.when(small, c.cast("long"))
    short = int_div(F.abs(narrow(n)) * F.lit(2 * unit) + narrow(d), narrow(d) * F.lit(2)).cast("decimal(38,0)")
    double = (d * F.lit(2)).cast("decimal(38,0)")
    top = (F.abs(n) * F.lit(2 * unit)).cast("decimal(38,0)") + d
    long = ((top - top % double) / double).cast("decimal(38,0)")
    quotient = F.when(small, short).otherwise(long)
    signed = F.when(n < 0, -quotient).otherwise(quotient)
    return F.when(d > 0, signed.cast("double") / F.lit(float(unit)))


def safe_ratio(num, den, scale: int) -> Column:
    """Half-up rounded ratio that is 0 when the denominator is 0 or NULL."""
    return F.coalesce(half_up_ratio(num, den, scale), F.lit(0.0))


def floor_days_between(earlier, later) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down (like timedelta.days)."""
    us = F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))
    day = F.lit(MICROS_PER_DAY)
    return F.when(us >= 0, int_div(us, day)).otherwise(-int_div(-us + day - F.lit(1), day))


def thousands(c) -> Column:
    """Integer rendered with thousands separators, e.g. ``12,345``."""
    return F.format_number(_col(c).cast("long"), 0)


def compact_timestamp(c) -> Column:
    """Time as ``yyyyMMdd_HHmmss`` (batch naming), in the session time zone (UTC)."""
    return F.date_format(_col(c), "yyyyMMdd_HHmmss")
