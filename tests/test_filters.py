from pyspark.sql import functions as F

from conftest import SF_MID
from dayload.operators import filters as FL
from dayload.plans.load import load_plan
from dayload.sources import vendor as V


def _rows(df):
    return sorted(tuple(r) for r in df.select("event_id", "OPMODE", "TRADE_DT").collect())


def test_union_form_equals_or_form(spark):
    V.register_vendor_views(spark, SF_MID)
    ev = spark.table("vendor_windevents")
    for day in ("20240101", "20240115", "20240130"):
        a = FL.incremental_filter(ev, V.WINDEVENTS, day, "change")
        b = FL.change_load_union(ev, V.WINDEVENTS, day)
        assert _rows(a) == _rows(b)


def test_modes_other_than_0_1_dropped(spark):
    V.register_vendor_views(spark, SF_MID)
    ev = spark.table("vendor_windevents")
    out = FL.incremental_filter(ev, V.WINDEVENTS, "20240115", "change")
    assert {r[0] for r in out.select("OPMODE").distinct().collect()} <= {"0", "1"}
    changed = out.where(F.col("OPMODE") == "1")
    assert changed.where(F.col("TRADE_DT") < "20240115").count() == 0


def test_change_day_pushes_a_range(spark):
    V.register_vendor_views(spark, SF_MID)
    plan = load_plan(spark, V.WINDEVENTS, "20240115", "change")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    # one scan, no union branch scanning twice
    assert plan.count("FileScan parquet") == 1


def test_entry_time_exact_match(spark):
    """Exact instant matching finds midnight-stamped orders but not the
    time-of-day stamped events."""
    V.register_vendor_views(spark, SF_MID)
    orders = FL.filter_entry_time(spark.table("vendor_ordersfeed"), "ENTRYTIME", V.OTHER_LOAD_DATE)
    assert orders.count() > 0
    ev = spark.table("vendor_windevents").withColumnRenamed("OPDATE", "ENTRYTIME")
    assert FL.filter_entry_time(ev, "ENTRYTIME", "20240115").count() == 0


def test_business_date_on_numeric_and_snapshot(spark):
    df = spark.createDataFrame([(1, 20240115), (2, 20240116)], "k long, d long")
    assert [r.k for r in FL.filter_business_date(df, "d", "20240115").collect()] == [1]
    assert FL.scan_snapshot(df).count() == 2
