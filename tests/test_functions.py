"""Scalar rules on literal edge rows (null, NaN, 'None', junk, infinity,
pre-1970 times, time-of-day values)."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayload.functions import (change_day_int, check_write_schema, day_bounds, day_text,
                               fill_float, fill_int, fill_string, load_date_of,
                               to_epoch_seconds, values_equal, yesterday)


def one_col(spark, values, dtype):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                 T.StructType([T.StructField("i", T.IntegerType()),
                                               T.StructField("v", dtype)]))


def col_values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_fill_float_double_input(spark):
    df = one_col(spark, [1.5, None, float("nan"), float("inf")], T.DoubleType())
    assert col_values(df, fill_float(F.col("v"), T.DoubleType())) == [1.5, 0.0, 0.0, float("inf")]


def test_fill_float_text_input(spark):
    df = one_col(spark, ["1.5", None, "None", "2.5", "Infinity"], T.StringType())
    assert col_values(df, fill_float(F.col("v"), T.StringType())) == [1.5, 0.0, 0.0, 2.5, float("inf")]


def test_fill_float_text_nan_survives(spark):
    df = one_col(spark, ["NaN"], T.StringType())
    assert math.isnan(col_values(df, fill_float(F.col("v"), T.StringType()))[0])


def test_fill_float_junk_raises(spark):
    df = one_col(spark, ["abc"], T.StringType())
    with pytest.raises(PySparkException):
        col_values(df, fill_float(F.col("v"), T.StringType()))


def test_fill_int_text_and_double(spark):
    df = one_col(spark, [None, "None", "7"], T.StringType())
    assert col_values(df, fill_int(F.col("v"), T.StringType())) == [0, 0, 7]
    df = one_col(spark, [1.9, -1.9, None, float("nan")], T.DoubleType())
    assert col_values(df, fill_int(F.col("v"), T.DoubleType())) == [1, -1, 0, 0]


def test_fill_int_fraction_text_raises(spark):
    df = one_col(spark, ["7.5"], T.StringType())
    with pytest.raises(PySparkException):
        col_values(df, fill_int(F.col("v"), T.StringType()))


def test_fill_int_timestamp_is_epoch_seconds(spark):
    df = one_col(spark, [dt.datetime(2022, 10, 26, 13, 14, 15, 678000), None], T.TimestampNTZType())
    assert col_values(df, fill_int(F.col("v"), T.TimestampNTZType())) == [1666790055, 0]


def test_fill_string(spark):
    df = one_col(spark, ["a", None, "None", "none", ""], T.StringType())
    assert col_values(df, fill_string(F.col("v"))) == ["a", "", "", "none", ""]


def test_epoch_seconds_cut_toward_zero(spark):
    df = one_col(spark, [dt.datetime(2022, 10, 26, 13, 14, 15, 678000),
                         dt.datetime(1969, 12, 31, 23, 59, 58, 500000)], T.TimestampNTZType())
    assert col_values(df, to_epoch_seconds(F.col("v"), T.TimestampNTZType())) == [1666790055, -1]


def test_change_day_from_epoch_and_null(spark):
    df = one_col(spark, [1666790055, 0, None, 20221026], T.LongType())
    assert col_values(df, change_day_int(F.col("v"), T.LongType())) == \
        [20221026, 19700101, 19700101, 19700823]


def test_change_day_from_timestamp(spark):
    df = one_col(spark, [dt.datetime(1969, 12, 31, 23, 59, 58, 500000), None], T.TimestampNTZType())
    assert col_values(df, change_day_int(F.col("v"), T.TimestampNTZType())) == [19691231, 19700101]


def test_time_rules_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        df = one_col(spark, [dt.datetime(2022, 10, 26, 23, 30)], T.TimestampNTZType())
        assert col_values(df, change_day_int(F.col("v"), T.TimestampNTZType())) == [20221026]
        assert col_values(df, day_text(F.col("v"), T.TimestampNTZType())) == ["20221026"]
        assert col_values(df, to_epoch_seconds(F.col("v"), T.TimestampNTZType())) == [1666827000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_check_write_schema(spark):
    df = one_col(spark, [2.0, 3.0], T.DoubleType())
    assert col_values(df, check_write_schema(F.col("v"), T.DoubleType(), T.IntegerType(), "v")) == [2, 3]
    bad = one_col(spark, [1.5], T.DoubleType())
    with pytest.raises(PySparkException):
        col_values(bad, check_write_schema(F.col("v"), T.DoubleType(), T.IntegerType(), "v"))
    big = one_col(spark, [2 ** 40], T.LongType())
    with pytest.raises(PySparkException):
        col_values(big, check_write_schema(F.col("v"), T.LongType(), T.IntegerType(), "v"))


def test_values_equal_nan_and_null(spark):
    rows = [(1, float("nan"), None), (2, float("nan"), float("nan")), (3, 1.0, 1.0),
            (4, 1.0, 1.5), (5, None, 2.0), (6, float("inf"), float("inf"))]
    df = spark.createDataFrame(rows, "i int, a double, b double")
    got = col_values(df, values_equal(F.col("a"), F.col("b"), T.DoubleType(), T.DoubleType()))
    assert got == [True, True, True, False, False, True]
    tol = col_values(df, values_equal(F.col("a"), F.col("b"), T.DoubleType(), T.DoubleType(), abs_tol=0.5))
    assert tol[3] is True


def test_dates():
    assert day_bounds("20240131") == ("2024-01-31", "2024-02-01")
    assert yesterday(dt.date(2024, 3, 1)) == "20240229"


def test_load_date_of(spark):
    df = one_col(spark, [dt.datetime(2024, 1, 1, 5)], T.TimestampNTZType())
    assert col_values(df, load_date_of(F.col("v"))) == ["20231231"]
    assert len(spark.range(1).select(load_date_of()).collect()[0][0]) == 8
