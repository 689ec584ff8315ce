"""Many tables at once: scheduler pools; the day's text report as one file."""

import os
from dataclasses import replace

from conftest import SF_SMALL
from dayload.plans import load
from dayload.plans.reconcile import write_text_report
from dayload.session import POOL, own_pool
from dayload.sources import vendor as V


def test_each_table_runs_in_its_own_pool(spark, root, monkeypatch):
    V.register_vendor_views(spark, SF_SMALL)
    seen, plan = {}, load.load_plan

    def spy(s, spec, *args, **kwargs):
        seen[spec.table_name] = s.sparkContext.getLocalProperty(POOL)
        return plan(s, spec, *args, **kwargs)

    monkeypatch.setattr(load, "load_plan", spy)
    load.load_all(spark, [V.NATIONSNAP, V.REGIONSNAP, V.WINDEVENTS], V.WIND_LOAD_DATE, root)
    assert seen == {t: f"load-{t}" for t in ("nationsnap", "regionsnap", "windevents")}
    assert spark.sparkContext.getLocalProperty(POOL) is None
    assert spark.sparkContext.getConf().get("spark.scheduler.mode") == "FAIR"


def test_pool_is_put_back(spark):
    sc = spark.sparkContext
    with own_pool(spark, "outer"):
        with own_pool(spark, "inner"):
            assert sc.getLocalProperty(POOL) == "inner"
        assert sc.getLocalProperty(POOL) == "outer"
    assert sc.getLocalProperty(POOL) is None


def test_small_table_ends_before_a_large_one(spark, root):
    V.register_vendor_views(spark, SF_SMALL)
    slow = "aggregate(sequence(0, 4000), 0L, (a, x) -> a + length(sha2(concat(x, id), 256)))"
    big = replace(V.REGIONSNAP, table_name="bigsnap", original_table="BIGSNAP",
                  source_sql=f"SELECT id AS r_regionkey, CAST({slow} AS STRING) AS r_name FROM range(0, 4000, 1, 100)")
    audit = {r["select_table"]: r for r in load.load_all(spark, [big, V.NATIONSNAP], "20240115", root, threads=2).collect()}
    assert audit["BIGSNAP"]["row_count"] == 4000 and audit["NATIONSNAP"]["row_count"] == 25
    assert audit["NATIONSNAP"]["loaded_at"] < audit["BIGSNAP"]["loaded_at"]


def test_text_report_is_one_file(spark, root):
    for text in ("first\n", "second \u00e4\n"):
        path = write_text_report(spark, text, root, "T", "20240115").removeprefix("file:")
        with open(path, encoding="utf-8") as f:
            assert f.read() == text
    assert [f for f in os.listdir(os.path.dirname(path)) if not f.startswith(".")] == ["20240115.txt"]


def test_text_report_replaces_the_older_layout(spark, root):
    spark.createDataFrame([("old",)], "value string").write.text(f"{root}/T/20240115.txt")
    path = write_text_report(spark, "new\n", root, "T", "20240115").removeprefix("file:")
    assert os.path.isfile(path)
