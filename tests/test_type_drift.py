"""Types over drifting files: the lattice's laws, merging, values that lose digits."""

import itertools

import pytest
from pyspark.sql import types as T

from tidemark.sources.files import common_type, common_types, drift_losses, merge_drifted

TYPE = {t.simpleString(): t for t in (
    T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(5, 2),
    T.DecimalType(12, 2), T.DecimalType(8, 4), T.DecimalType(12, 4), T.DecimalType(10, 5), T.DecimalType(38, 0), T.DateType(),
    T.TimestampNTZType(), T.TimestampType(), T.BooleanType(), T.StringType(), T.BinaryType(), T.NullType(), T.ArrayType(T.LongType()))}
TYPES = list(TYPE.values())


@pytest.mark.parametrize("a, b, want", [("int", "bigint", "bigint"), ("bigint", "double", "double"), ("int", "decimal(5,2)", "decimal(12,2)"),
                                        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(10,5)", "double"),
                                        ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp_ntz", "timestamp", "timestamp"),
                                        ("boolean", "int", "string"), ("date", "int", "string"), ("float", "float", "float"),
                                        ("int", "float", "double"), ("void", "date", "date")])
def test_common_type(a, b, want):
    one, two, three = TYPE[a], TYPE[b], TYPE[want]
    assert common_type(one, two) == common_type(two, one) == three


def test_order_does_not_matter():
    for a, b in itertools.product(TYPES, TYPES):
        assert common_type(a, b) == common_type(b, a) and common_type(a, a) == a
    for a, b, c in itertools.product(TYPES, TYPES, TYPES):
        # a decimal of over 38 digits is the one place where the way counts: it may pass through double
        if sum(isinstance(x, T.DecimalType) for x in (a, b, c)) < 2:
            assert common_type(common_type(a, b), c) == common_type(a, common_type(b, c)), (a, b, c)


def test_merge_widens_and_keeps_columns(spark):
    one = spark.sql("SELECT 1 AS a, 2 AS b, DATE'2025-01-02' AS d, array(1) AS n")
    two = spark.sql("SELECT 3000000000 AS a, 1.5D AS b, TIMESTAMP_NTZ'2025-01-02 03:00:00' AS d, 'x' AS n, true AS new")
    three = spark.sql("SELECT 'text' AS a, CAST(NULL AS INT) AS b")
    out = merge_drifted(one, two, three)
    assert dict(out.dtypes) == {"a": "string", "b": "double", "d": "timestamp_ntz", "n": "string", "new": "boolean"}
    assert {(r["a"], r["b"], str(r["d"]), r["n"], r["new"]) for r in out.collect()} == {
        ("1", 2.0, "2025-01-02 00:00:00", "[1]", None), ("3000000000", 1.5, "2025-01-02 03:00:00", "x", True), ("text", None, "None", None, None)}
    assert {k: t.simpleString() for k, t in common_types([one, three]).items()} == {"a": "string", "b": "int", "d": "date", "n": "array<int>"}


def test_losses_are_listed_by_value(spark):
    big = 2 ** 53
    one = spark.createDataFrame([(big,), (big + 1,), (big + 1,), (None,), (-big - 1,)], "x bigint")
    two = spark.createDataFrame([(0.5,)], "x double")
    got = {(r["value"], r["rows"]) for r in drift_losses(spark, one, two, one).collect()}
    assert got == {(str(big + 1), 4), (str(-big - 1), 2)}
    assert drift_losses(spark, two, spark.createDataFrame([("a",)], "x string")).collect() == []
    money = spark.sql("SELECT CAST('12345678901234567.89' AS DECIMAL(19,2)) AS x UNION ALL SELECT CAST('0.25' AS DECIMAL(19,2))")
    assert [r["value"] for r in drift_losses(spark, money, two).collect()] == ["12345678901234567.89"]
