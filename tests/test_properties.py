"""Property tests: generated batches checked against plain-Python rules.
Each example is one small DataFrame, so one Spark job checks many values."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayload.functions import change_day_int, fill_float, fill_int, fill_string, to_epoch_seconds
from dayload.operators.reconcile import reconcile
from test_reconcile import brute_force

EPOCH = dt.datetime(1970, 1, 1)
SLOW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

times = st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1))


@SLOW
@given(st.lists(st.one_of(st.none(), times), min_size=1, max_size=60))
def test_time_rules_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v timestamp_ntz")
    got = df.orderBy("i").select(to_epoch_seconds(F.col("v"), T.TimestampNTZType()).alias("e"),
                                 change_day_int(F.col("v"), T.TimestampNTZType()).alias("d"),
                                 fill_int(F.col("v"), T.TimestampNTZType()).alias("f")).collect()
    for v, r in zip(values, got):
        if v is None:
            assert (r["e"], r["d"], r["f"]) == (None, 19700101, 0)
        else:
            micros = (v - EPOCH) // dt.timedelta(microseconds=1)
            exp = abs(micros) // 1_000_000 * (1 if micros >= 0 else -1)
            assert r["e"] == exp == r["f"]
            assert r["d"] == int(v.strftime("%Y%m%d"))


@SLOW
@given(st.lists(st.one_of(st.none(), st.just(float("nan")), st.just(float("inf")),
                          st.floats(min_value=-1e15, max_value=1e15)),
                min_size=1, max_size=60))
def test_number_fills_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = df.orderBy("i").select(fill_float(F.col("v"), T.DoubleType()).alias("f"),
                                 F.when(F.col("v").isNull() | F.isnan("v") | (F.abs(F.col("v")) < 9e18),
                                        fill_int(F.col("v"), T.DoubleType()))
                                 .alias("n")).collect()
    for v, r in zip(values, got):
        if v is None or math.isnan(v):
            assert r["f"] == 0.0
        else:
            assert r["f"] == v
        if v is None or math.isnan(v):
            assert r["n"] == 0
        elif math.isfinite(v):
            assert r["n"] == int(v)  # cut toward zero


@SLOW
@given(st.lists(st.one_of(st.none(), st.sampled_from(["None", "none", "", "a", " None", "x y"])),
                min_size=1, max_size=40))
def test_string_fill_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(fill_string(F.col("v"))).collect()]
    assert got == ["" if v is None or v == "None" else v for v in values]


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)),   # key, repeats and nulls
                          st.integers(0, 2),                         # value
                          st.sampled_from(["a", "b", None])),        # text
                min_size=0, max_size=30)


@SLOW
@given(rows, rows)
def test_reconcile_matches_brute_force(spark, left_rows, right_rows):
    schema = "k long, v long, s string"
    l = spark.createDataFrame(left_rows, schema)
    r = spark.createDataFrame(right_rows, schema)
    exp = brute_force(left_rows, right_rows, (0,))
    for split in ({}, {"hot_group_rows": 1, "block_rows": 2}):
        got = reconcile(l, r, ["k"], **split).counts().collect()[0].asDict()
        assert got == exp, split
    same = reconcile(l, l, ["k"]).counts().collect()[0].asDict()
    assert same["rows_all_equal"] == len(left_rows) and same["rows_left_only"] == 0
