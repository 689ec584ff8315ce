"""The chunked source over a cursor and over Parquet row groups."""

import datetime as dt
import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import chunk_stub
from dayload.catalog import ColumnSpec, TableSpec
from dayload.plans.load import load_plan
from dayload.sources.chunked import ChunkedConnection, Condition, _cuts, scan_chunks

COLUMNS = (ColumnSpec("id", "bigint", "int64", "int64"), ColumnSpec("name", "varchar(20)", "str", "string"), ColumnSpec("at", "datetime", "int64", "int64"))


@pytest.fixture()
def log(spark, tmp_path, monkeypatch):
    """The stub's statements; workers are started with the file's name."""
    path = str(tmp_path / "log.txt")
    env = spark.sparkContext.environment
    monkeypatch.setitem(env, "CHUNK_STUB_LOG", path)
    monkeypatch.setenv("CHUNK_STUB_LOG", path)
    here = os.path.dirname(os.path.abspath(__file__))
    for p in (here, os.path.dirname(here)):
        if p not in env.get("PYTHONPATH", "").split(os.pathsep):
            monkeypatch.setitem(env, "PYTHONPATH", os.pathsep.join([p, *filter(None, [env.get("PYTHONPATH")])]))
    assert chunk_stub.NAMES and here in sys.path
    return lambda: open(path).read().splitlines() if os.path.exists(path) else []


def test_cursor_is_read_in_ranges_and_chunks(spark, log):
    source = ChunkedConnection("chunk_stub:connect", "id", 4, 150)
    df = source.scan(spark, "SELECT * FROM t", COLUMNS)
    assert sorted(tuple(r) for r in df.collect()) == [r[:3] for r in chunk_stub.ROWS]
    lines = log()
    selects = [x for x in lines if x.startswith("SELECT id")]
    assert len(selects) == 4 and lines.count("closed") == 5
    assert all(int(x.split()[1]) <= 150 for x in lines if x.startswith("fetched"))
    assert sum(x == "fetched 0" for x in lines) == 4


def test_bounds_are_those_of_the_day(spark, log):
    df = ChunkedConnection("chunk_stub:connect", "id", 3, 100).scan(spark, "SELECT * FROM t", COLUMNS)
    day = df.where((F.col("at") >= F.lit("2024-01-11").cast("timestamp_ntz")) & (F.col("at") < F.lit("2024-01-12").cast("timestamp_ntz")))
    plan = explained(day)
    assert sorted(r["id"] for r in day.collect()) == list(range(240, 264))
    asked = [x for x in log() if "MIN(id)" in x][-1]
    assert "at >= ?" in asked and "at < ?" in asked and "datetime.datetime(2024, 1, 11" in asked
    ranges = [x for x in log() if x.startswith("SELECT id")]
    assert len(ranges) == 3 and any("240" in x and "247" in x for x in ranges)
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(at,2024-01-11" in plan and "LessThan(at,2024-01-12" in plan and "Filter" not in plan.replace("PushedFilters", "")


def test_rows_without_a_key_are_read_once(spark, log):
    df = ChunkedConnection("chunk_stub:connect", "value", 5, 999).scan(spark, "SELECT * FROM t", (COLUMNS[0], ColumnSpec("value", "float", "float64", "double")))
    got = sorted(tuple(r) for r in df.where("id < 500").select("id").collect())
    assert got == [(i,) for i in range(500)]


def test_a_table_is_loaded_through_the_cursor(spark, log):
    spec = TableSpec("t", "other", "T", "SELECT * FROM t", True, True, "name", ("id",), (*COLUMNS[:2], ColumnSpec("ENTRYTIME", "datetime", "int64", "int64")))
    rows = ChunkedConnection("chunk_stub:connect").scan(spark, "SELECT * FROM t", COLUMNS)
    out = load_plan(spark, spec, "20240105", "change", source=rows.withColumnRenamed("at", "ENTRYTIME")).collect()
    assert [(r["id"], r["name"], r["ENTRYTIME"]) for r in out] == [(96, "n96", 20240105)]


def test_parquet_row_groups(spark, tmp_path):
    t = pa.table({"id": range(10_000), "at": [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i) for i in range(10_000)], "x": ["a"] * 10_000})
    (tmp_path / "d").mkdir()
    pq.write_table(t.slice(0, 6_000), tmp_path / "d/a.parquet", row_group_size=500)
    pq.write_table(t.slice(6_000), tmp_path / "d/b.parquet", row_group_size=500)
    df = scan_chunks(spark, str(tmp_path / "d"), ["id", "at"], chunk_rows=1_000)
    assert df.dtypes == [("id", "bigint"), ("at", "timestamp_ntz")] and df.rdd.getNumPartitions() == 10
    few = df.where("id >= 1200 and id < 1300")
    assert few.rdd.getNumPartitions() == 1 and sorted(r["id"] for r in few.collect()) == list(range(1200, 1300))
    assert df.where("at > timestamp_ntz'2024-01-07 20:00:00'").count() == 10_000 - 9_841 + 0
    assert df.where("id in (5, 7777) or id = 9").count() == 3 and df.where("id = -4").count() == 0
    assert "GreaterThanOrEqual(id,1200)" in explained(few)


def test_plans_over_one_relation_keep_their_own_filters(spark, tmp_path):
    """A plan without filters of its own must not be planned with those of the one before."""
    pq.write_table(pa.table({"id": range(1_000), "x": [float("nan") if i % 2 else i / 1 for i in range(1_000)], "s": ["a", "B"] * 500}), tmp_path / "t.parquet", row_group_size=100)
    df = scan_chunks(spark, str(tmp_path / "t.parquet"))
    assert [df.where("id < 150").count(), df.count(), df.where("id = 7 or id + 1 = 3").count(), df.where("id < 0").count(), df.count()] == [150, 1_000, 2, 0, 1_000]
    assert df.where("x > 990").count() == 500 + 4 and df.where("s = 'B' and id < 10").count() == 5
    assert df.where("x > 990").join(df.where("id > 995"), "id").count() == 4


def explained(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_conditions_and_cuts():
    assert _cuts(0, 10, 5) == [2, 4, 6, 8] and _cuts(3, 4, 8) == [] and _cuts("a", "b", 3) == []
    assert _cuts(dt.date(2024, 1, 1), dt.date(2024, 1, 5), 2) == [dt.date(2024, 1, 3)]
    assert not Condition("a", ">", 5).may_hold(1, 5) and Condition("a", ">=", 5).may_hold(1, 5) and Condition("a", "=", "x").may_hold(1, 5)
    assert not Condition("a", "in", (0, 9)).may_hold(1, 5) and Condition("a", "in", (3,)).text("?") == ("a IN (?)", [3])
