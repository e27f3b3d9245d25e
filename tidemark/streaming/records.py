"""Decoding of stream records: base64 → UTF-8 text → JSON object.

A record is a row ``(sequence_number string, value string)`` where ``value``
holds a base64-encoded JSON object. Decoding never raises: every failure is
turned into a ``_dead_letter_reason`` so one bad record never fails a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEAD_LETTER_COL = "_dead_letter_reason"
CORRUPT_COL = "_corrupt_record"

# The clickstream payload fields; parsed as text (typing happens in staging,
# so a value of an unexpected JSON type never makes the whole record corrupt).
CLICKSTREAM_FIELDS = ("event_id", "customer_id", "session_id", "event_ts", "event_type",
                      "product_id", "device_type", "traffic_source")


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType(), True) for f in fields] +
                        [T.StructField(CORRUPT_COL, T.StringType(), True)])


def decode_records(records: DataFrame, fields: Sequence[str] = CLICKSTREAM_FIELDS,
                   value_col: str = "value", seq_col: str = "sequence_number", keep: Sequence[str] = ()) -> DataFrame:
    """Columns: ``_sequence_number``, one text column per payload field,
    ``_payload`` (decoded text), ``_dead_letter_reason`` (NULL when good) and those of ``keep``.

    Reasons: ``invalid_base64`` (value missing or not base64),
    ``invalid_utf8`` (bytes are not UTF-8), ``empty_payload`` (no text),
    ``malformed_json`` (not a JSON object: bad syntax, array, number, null).
    """
    raw = F.try_to_binary(F.col(value_col).cast("string"), F.lit("base64"))
    text = F.try_validate_utf8(raw.cast("string"))
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    staged = records.select(
        F.col(seq_col).cast("string").alias("_sequence_number"),
        F.col(value_col).isNull().alias("_missing"), raw.isNull().alias("_bad64"),
        text.alias("_payload"), *keep)
    # A generator is a barrier: Catalyst neither repeats what feeds it nor moves filters below it, so
    # every record is decoded and parsed once, whatever is read from the result.
    parsed = staged.select(F.inline(F.array(F.struct(
        "_sequence_number", "_missing", "_bad64", "_payload",
        F.from_json("_payload", text_schema(fields), opts).alias("_obj"), *keep))))
    reason = (F.when(F.col("_missing") | F.col("_bad64"), F.lit("invalid_base64"))
              .when(F.col("_payload").isNull(), F.lit("invalid_utf8"))
              .when(F.trim(F.col("_payload")) == F.lit(""), F.lit("empty_payload"))
              .when(F.col("_obj").isNull() | F.col(f"_obj.{CORRUPT_COL}").isNotNull(),
                    F.lit("malformed_json")))
    return parsed.select(
        "_sequence_number", *[F.col(f"_obj.`{f}`").alias(f) for f in fields],
        "_payload", reason.alias(DEAD_LETTER_COL), *keep)


def good_records(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(DEAD_LETTER_COL).isNull()).drop(DEAD_LETTER_COL, "_payload")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """(_sequence_number, _payload, _dead_letter_reason) of the rejected records."""
    return decoded.filter(F.col(DEAD_LETTER_COL).isNotNull()) \
        .select("_sequence_number", "_payload", DEAD_LETTER_COL)


def encode_records(df: DataFrame, seq_col: str, fields: Sequence[str] | None = None) -> DataFrame:
    """The inverse: (sequence_number, value = base64(JSON object of ``fields``))."""
    fields = list(fields or [c for c in df.columns])
    payload = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]))
    return df.select(F.col(seq_col).cast("string").alias("sequence_number"),
                     F.base64(F.encode(payload, "UTF-8")).alias("value"))
