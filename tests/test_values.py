import hashlib
import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import values

DOUBLE, LONG, TEXT = T.DoubleType(), T.LongType(), T.StringType()


def evaluate(spark, column, schema, *cells):
    df = spark.createDataFrame([(i, cell) for i, cell in enumerate(cells)], f"i int, v {schema}")
    return [row.out for row in df.select("i", column(F.col("v")).alias("out")).orderBy("i").collect()]


FLOATS = [
    0.0, -0.0, 1.0, 0.01, -3.5, 17.25, 9999999.99, 1e7, 12345678.9, -98765432.125, 1e15, 1e16, 1.5e16, 1e22,
    0.001, 0.0005, 1e-4, -1.25e-4, 1e-5, 1.5e-5, -2.5e-7, 1e-10, 1e100, 1e-100, math.inf, -math.inf, math.nan,
]


def test_float_text_is_plain_between_1e_4_and_1e16(spark):
    assert evaluate(spark, values.float_text, "double", *FLOATS) == [repr(value) for value in FLOATS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.decimals(min_value=-(10**9), max_value=10**9, places=2).map(float), min_size=50, max_size=50))
def test_float_text_of_amounts(spark, amounts):
    assert evaluate(spark, values.float_text, "double", *amounts) == [repr(amount) for amount in amounts]


def test_key_parts_have_tokens_for_missing_values(spark):
    row = spark.sql("SELECT CAST(NULL AS DOUBLE) f, CAST(NULL AS BIGINT) i, CAST(NULL AS TIMESTAMP_NTZ) t")
    kinds = {field.name: field.dataType for field in row.schema.fields}
    found = row.select(*[values.key_text(F.col(name), kinds[name]).alias(name) for name in "fit"]).first()
    assert tuple(found) == ("nan", "<NA>", "NaT")


def test_key_keeps_fractions_of_seconds_apart(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2020-01-01 00:00:00' a, TIMESTAMP_NTZ'2020-01-01 00:00:00.25' b")
    found = row.select(*[values.key_text(F.col(name), T.TimestampNTZType()).alias(name) for name in "ab"]).first()
    assert tuple(found) == ("2020-01-01 00:00:00", "2020-01-01 00:00:00.25")


def test_md5_key(spark):
    found = spark.range(1).select(values.md5_key([F.lit("1"), F.lit("2020"), F.lit("x")]).alias("k")).first()
    assert found.k == hashlib.md5(b"12020x").hexdigest()


def test_coerce_int(spark):
    def coerce(kind):
        return lambda column: values.coerce_int(column, kind)

    texts = ["7", " 8 ", "3.9", "-3.9", "1e3", "x", "", "1d", "nan", None]
    assert evaluate(spark, coerce(TEXT), "string", *texts) == [7, 8, 3, -3, 1000, 0, 0, 0, 0, 0]
    assert evaluate(spark, coerce(DOUBLE), "double", 3.7, -3.7, math.nan, None) == [3, -3, 0, 0]
    assert evaluate(spark, coerce(LONG), "bigint", 5, None) == [5, 0]
    for kind, schema, cell in ((LONG, "bigint", 2**31), (DOUBLE, "double", 3e9), (TEXT, "string", "3e9")):
        with pytest.raises(Exception, match="OVERFLOW"):
            evaluate(spark, coerce(kind), schema, cell)


def test_money_rounds_the_written_number(spark):
    cells = [1.005, 2.675, -1.005, 3.0, math.nan, None]
    expected = [Decimal("1.01"), Decimal("2.68"), Decimal("-1.01"), Decimal("3.00"), None, None]
    assert evaluate(spark, values.to_money, "double", *cells) == expected
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        evaluate(spark, values.to_money, "double", 1e8)


def test_strict_long(spark):
    def strict(kind):
        return lambda column: values.strict_long(column, kind)

    texts = ["1", "1.0", "-2", "9007199254740993", "1e3", None]
    assert evaluate(spark, strict(TEXT), "string", *texts) == [1, 1, -2, 9007199254740993, 1000, None]
    assert evaluate(spark, strict(DOUBLE), "double", 4.0, math.nan, None) == [4, None, None]
    for kind, schema, cell in ((DOUBLE, "double", 1.5), (TEXT, "string", "1.5"), (TEXT, "string", "x")):
        with pytest.raises(Exception, match="not an integer|CAST_INVALID_INPUT"):
            evaluate(spark, strict(kind), schema, cell)


def test_missing_tokens(spark):
    cells = ["N/A", "NA", "", "null", "Unknown", "nano", None]
    expected = [None, None, None, None, "Unknown", "nano", None]
    assert evaluate(spark, values.missing_to_null, "string", *cells) == expected
