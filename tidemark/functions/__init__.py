"""Column-level helpers: built-in Spark expressions only, no Python UDFs."""

from tidemark.functions.scalar import (  # noqa: F401
    coerce_amount,
    compact_timestamp,
    coerce_quantity,
    floor_days_between,
    half_up_ratio,
    int_div,
    is_present,
    safe_ratio,
    thousands,
)
