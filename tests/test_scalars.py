from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.functions import scalars as S
from tests.fixtures import expected_key


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema).coalesce(1)
    return [r[0] for r in df.select(column.alias("v")).collect()]


def test_month_start(spark):
    found = values(spark, [("202502",), (None,)], "m string", S.month_start("m"))
    assert [str(v) for v in found] == ["2025-02-01", "None"]


@pytest.mark.parametrize("bad", ["202513", "2025-02", "x"])
def test_month_start_bad_text(spark, bad):
    assert values(spark, [(bad,)], "m string", S.month_start("m", strict=False)) == [None]
    with pytest.raises(Exception, match="CANNOT_PARSE|cannot be parsed|could not be parsed"):
        values(spark, [(bad,)], "m string", S.month_start("m"))


def test_pad_id(spark):
    rows = [("123",), ("1234567890123456",), (None,)]
    assert values(spark, rows, "x string", S.pad_id("x")) == [
        "00000000000123", "12345678901234", None
    ]
    assert values(spark, [(42,)], "x bigint", S.pad_id("x")) == ["00000000000042"]


def test_clean_text_removes_every_delimiter(spark):
    rows = [("a;b\nc\r;d",), (None,), ("plain",)]
    assert values(spark, rows, "x string", S.clean_text("x")) == ["abcd", None, "plain"]


def test_round_to_int(spark):
    doubles = [(0.5,), (1.5,), (2.5,), (-2.5,), (None,)]
    assert values(spark, doubles, "x double", S.round_to_int("x", T.DoubleType())) == [
        0, 2, 2, -2, None
    ]
    decimals = [(Decimal("2.5"),), (Decimal("-2.5"),)]
    kind = T.DecimalType(5, 1)
    assert values(spark, decimals, "x decimal(5,1)", S.round_to_int("x", kind)) == [3, -3]


@pytest.mark.parametrize("value, source, target", [
    (3e9, T.DoubleType(), "int"),
    (123456789012.0, T.DoubleType(), "decimal(15,4)"),
])
def test_overflow_is_an_error(spark, value, source, target):
    column = S.cast_as("x", source, target)
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|out of range|overflow"):
        values(spark, [(value,)], "x double", column)


def test_surrogate_keys_differ(spark):
    tuples = [("a", None), (None, "a"), ("ab", "c"), ("a", "bc"), ("", "a"), ("a", ""),
              ("-", "a"), ("1:a", "b"), ("a", "1:b"), (None, None), ("", "")]
    keys = values(spark, tuples, "a string, b string", S.surrogate_key("a", "b"))
    assert len(set(keys)) == len(tuples)
    assert all(len(k) == 32 for k in keys)


text = st.one_of(st.none(), st.text(st.characters(codec="utf-8", exclude_characters="\x00"),
                                    max_size=8))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=40))
def test_surrogate_key_value(spark, tuples):
    keys = values(spark, tuples, "a string, b string", S.surrogate_key("a", "b"))
    assert keys == [expected_key(t) for t in tuples]
    assert len(set(keys)) == len(set(tuples))


def test_window_start(spark):
    column = S.window_start(S.date_value("2001-08-15"), 24)
    assert [str(v) for v in values(spark, [(1,)], "x int", column)] == ["1999-08-01"]


def test_scalars_stay_in_codegen(spark):
    df = spark.range(1).select(F.lit("a").alias("a"), F.col("id").cast("string").alias("b"))
    plan = df.select(S.surrogate_key("a", "b"), S.clean_text("a"), S.pad_id("b"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
