"""Raw → staged: typed, validated, deduplicated tables.

A fact is *tagged* in one pass: columns are typed first, then every row gets a
``_reject_reason`` (NULL for a valid row) from one CASE. Known customers are
found by one left outer join on typed keys against distinct customer keys; AQE can
split that join when one customer is hot. The row as it arrived travels in
``_raw``, so rejects keep the text that was refused.

``stage_*`` return ``(tagged, clean)``, both lazy; clean holds the first row per
key. Rows whose key is NULL after typing are rejected as ``invalid_key``, so
clean + rejected + duplicates always equals the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import coerce_amount, coerce_quantity, is_present
from tidemark.operators.cleanse import REJECT_COL, tag_rejects, valid_rows
from tidemark.operators.dedupe import dedupe_first

RAW_COL = "_raw"
CLICKSTREAM_REASONS = ("invalid_key", "missing_customer")
TRANSACTION_REASONS = ("invalid_key", "invalid_quantity", "invalid_amount", "missing_customer", "unknown_customer")


def _typed(c: str, dtype: str | None) -> Column:
    if not dtype or dtype == "string":
        return F.col(c)
    return F.trim(F.col(c).cast("string")).try_cast(dtype)


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Lenient typing of text columns: ``try_cast`` (NULL on failure, never an error)."""
    return df.select(*[(_typed(c, types.get(c)) if c in types else F.col(c)).alias(c) for c in df.columns])


def _stamp(df: DataFrame, stamp) -> DataFrame:
    """Add ``_cleansed_ts``: ``"now"`` (current time), a Column, or None (omit)."""
    if stamp is None:
        return df
    if isinstance(stamp, str):
        return df.withColumn("_cleansed_ts", F.current_timestamp())
    return df.withColumn("_cleansed_ts", stamp)


def _key_ok(key: Sequence[str]) -> Column:
    ok = F.lit(True)
    for k in key:
        ok = ok & F.col(k).isNotNull()
    return ok


def tag_clickstream(raw: DataFrame, key: Sequence[str] = ("event_id",), customer: str = "customer_id",
                    types: dict[str, str] | None = None, valid_customers: DataFrame | None = None) -> DataFrame:
    """Typed clickstream rows with a reason: key unreadable, anonymous (NULL, empty or unreadable
    customer), or of an unknown customer when the known ones are given."""
    types = types or {}
    df = apply_types(_arrived(raw, valid_customers, customer, customer, types), types)
    return _tag_known(df, [("invalid_key", _key_ok(key)), ("missing_customer", is_present(customer))])


def _arrived(raw: DataFrame, valid_customers: DataFrame | None, customer: str, customer_key: str, types: dict[str, str]) -> DataFrame:
    """The rows with ``_raw``, and with ``_known`` by one left join with the known customers, if they are given.

    The join comes before the typing, so a shuffle of it moves each row once, as it arrived, and not its typed columns too.
    """
    row = F.struct(*[F.col(c) for c in raw.columns])
    if valid_customers is None:
        return raw.withColumn(RAW_COL, row)
    asked = raw.withColumn("_customer", _typed(customer, types.get(customer)))
    known = valid_customers.select(F.col(customer_key).cast("string").try_cast(dict(asked.dtypes)["_customer"]).alias("_known")) \
        .filter(F.col("_known").isNotNull())
    # Distinct by key and a function of it: rows stay unique by key, but their partitioning is not
    # the join's, so the join gets an exchange of its own on both sides. Only such a join can
    # be split by AQE when one customer holds most rows.
    known = known.withColumn("_half", F.pmod(F.xxhash64("_known"), F.lit(2))).distinct().select("_known")
    return asked.join(known, F.col("_customer") == F.col("_known"), "left").withColumn(RAW_COL, row).drop("_customer")


def _tag_known(df: DataFrame, rules: list) -> DataFrame:
    """The rules, and ``unknown_customer`` if the known customers were asked for."""
    if "_known" not in df.columns:
        return tag_rejects(df, rules)
    return tag_rejects(df, [*rules, ("unknown_customer", F.col("_known").isNotNull())]).drop("_known")


def tag_transactions(raw: DataFrame, valid_customers: DataFrame | None = None,
                     key: Sequence[str] = ("order_id",), customer: str = "customer_id",
                     customer_key: str | None = None, quantity: str = "quantity",
                     amount: str = "amount", types: dict[str, str] | None = None) -> DataFrame:
    """Typed transaction rows with a reason: key, quantity and amount (both > 0), customer present and known."""
    types = {c: t for c, t in (types or {}).items() if c not in (quantity, amount)}
    df = apply_types(_arrived(raw, valid_customers, customer, customer_key or customer, types), types).withColumns({quantity: coerce_quantity(quantity), amount: coerce_amount(amount)})
    rules = [("invalid_key", _key_ok(key)), ("invalid_quantity", F.col(quantity) > 0),
             ("invalid_amount", F.col(amount) > 0), ("missing_customer", is_present(customer))]
    return _tag_known(df, rules)


def stage_clickstream(raw: DataFrame, key: Sequence[str] = ("event_id",),
                      customer: str = "customer_id", order_by: Sequence[str] = ("event_ts",),
                      types: dict[str, str] | None = None,
                      stamp: Column | str | None = "now"):
    """Drop rows without a key or customer, keep the first row per key."""
    tagged = tag_clickstream(raw, key, customer, types)
    clean = dedupe_first(valid_rows(tagged).drop(RAW_COL), list(key), list(order_by))
    return tagged, _stamp(clean, stamp)


def stage_transactions(raw: DataFrame, valid_customers: DataFrame | None = None,
                       key: Sequence[str] = ("order_id",), customer: str = "customer_id",
                       customer_key: str | None = None, quantity: str = "quantity",
                       amount: str = "amount", order_by: Sequence[str] = (),
                       types: dict[str, str] | None = None,
                       stamp: Column | str | None = "now"):
    """Coerce quantity/amount, require both > 0, require a (known) customer, keep the first row per key."""
    tagged = tag_transactions(raw, valid_customers, key, customer, customer_key, quantity, amount, types)
    clean = dedupe_first(valid_rows(tagged).drop(RAW_COL), list(key), list(order_by))
    return tagged, _stamp(clean, stamp)


def stage_passthrough(raw: DataFrame, types: dict[str, str] | None = None,
                      stamp: Column | None = None) -> DataFrame:
    """Declared-schema pass-through (customers, products)."""
    return _stamp(apply_types(raw, types or {}), stamp)


__all__ = ["REJECT_COL", "RAW_COL", "CLICKSTREAM_REASONS", "TRANSACTION_REASONS", "apply_types", "tag_clickstream",
           "tag_transactions", "stage_clickstream", "stage_transactions", "stage_passthrough"]
