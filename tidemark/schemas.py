"""Declared schemas of the shop domain (raw: all text; staged: typed)."""

from __future__ import annotations

RAW_COLUMNS = {
    "customers": ("customer_id", "signup_date", "country", "marketing_opt_in"),
    "products": ("product_id", "category", "price"),
    "clickstream_events": ("event_id", "customer_id", "session_id", "event_ts", "event_type",
                           "product_id", "device_type", "traffic_source"),
    "transactions": ("order_id", "customer_id", "product_id", "order_date", "quantity",
                     "amount", "status"),
}

# Staged types applied with try_cast (columns not listed stay text).
STAGED_TYPES = {
    "customers": {"signup_date": "date", "marketing_opt_in": "boolean"},
    "products": {"price": "decimal(12,2)"},
    "clickstream_events": {"event_ts": "timestamp"},
    "transactions": {"order_date": "date"},
}
