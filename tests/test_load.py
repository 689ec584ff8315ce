
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from dayload.catalog import LOAD_DATE
from dayload.operators.project import MissingColumnsError, project_declared
from dayload.plans.load import load_all, load_table
from dayload.sinks.writers import read_audit, read_sidecar, write_slice, write_snapshot
from dayload.sources import vendor as V
from dayload.sources.store import scan_load_date, scan_snapshot_table


@pytest.fixture(autouse=True)
def views(spark):
    V.register_vendor_views(spark, SF_MID)


def test_rerun_replaces_only_that_day(spark, root):
    t = V.WINDEVENTS.original_table
    load_table(spark, V.WINDEVENTS, "20240115", root, "change")
    load_table(spark, V.WINDEVENTS, "20240116", root, "change")
    first = scan_load_date(spark, root, t, "20240115").count()
    other = scan_load_date(spark, root, t, "20240116").count()
    load_table(spark, V.WINDEVENTS, "20240115", root, "change")
    assert scan_load_date(spark, root, t, "20240115").count() == first
    assert scan_load_date(spark, root, t, "20240116").count() == other


def test_shrinking_rerun_leaves_no_stale_rows(spark, root):
    src = spark.table("vendor_windevents")
    load_table(spark, V.WINDEVENTS, "20240115", root, "change", source=src)
    full = scan_load_date(spark, root, "WINDEVENTS", "20240115").count()
    load_table(spark, V.WINDEVENTS, "20240115", root, "change", source=src.where("event_id % 2 = 0"))
    assert 0 < scan_load_date(spark, root, "WINDEVENTS", "20240115").count() < full


def test_empty_load_keeps_old_slice_and_reports_empty(spark, root):
    src = spark.table("vendor_windevents")
    load_table(spark, V.WINDEVENTS, "20240115", root, "change", source=src)
    before = scan_load_date(spark, root, "WINDEVENTS", "20240115").count()
    audit = load_table(spark, V.WINDEVENTS, "20240115", root, "change", source=src.limit(0)).collect()[0]
    assert audit["table_empty"] and audit["row_count"] == 0 and audit["table_path"] == ""
    assert scan_load_date(spark, root, "WINDEVENTS", "20240115").count() == before


def test_output_schema_and_no_nulls(spark, root):
    load_table(spark, V.WINDEVENTS, "20240115", root, "change")
    df = scan_load_date(spark, root, "WINDEVENTS", "20240115")
    assert df.columns == ["event_id", "OPDATE", "OPMODE", "TRADE_DT", "user_id", "value_num",
                          "value_txt", "UPDATE_TIME", LOAD_DATE]
    types = dict(df.dtypes)
    assert types["OPDATE"] == "bigint" and types[LOAD_DATE] == "bigint"
    nulls = df.select([F.count_if(F.col(c).isNull() | F.isnan(c) if t == "double" else F.col(c).isNull())
                       .alias(c) for c, t in df.dtypes]).collect()[0]
    assert all(v == 0 for v in nulls)
    assert {r[0] for r in df.select(F.substring(F.col("OPDATE").cast("string"), 1, 8)).distinct().collect()} == {"20240115"}
    meta = df.schema["value_num"].metadata
    assert meta.get("parquet_type") == "double"


def test_strict_profile_needs_every_declared_column(spark, root):
    src = spark.table("vendor_windevents")
    with pytest.raises(MissingColumnsError):
        project_declared(src, V.WINDEVENTS.all_cols, strict=True)
    audit = load_table(spark, V.WINDEVENTS, "20240115", root, "v1").collect()[0]
    assert audit["status"] == "failed" and "MISSING_COL" in audit["error"]


def test_bounded_files(spark, root):
    df = spark.range(2500).withColumn("x", F.col("id") * 2).coalesce(1)
    res = write_slice(df, root, "T", "20240101", max_records=1000)
    assert res.rows == 2500 and res.files >= 3
    per_file = (spark.read.parquet(res.path).groupBy(F.input_file_name()).count()
                .agg(F.max("count")).collect()[0][0])
    assert per_file <= 1000


def test_snapshot_empty_keeps_old(spark, root):
    df = spark.range(5)
    write_snapshot(df, root, "S")
    res = write_snapshot(df.limit(0), root, "S")
    assert res.empty and scan_snapshot_table(spark, root, "S").count() == 5


def test_sidecar_and_audit(spark, root):
    out = load_all(spark, [V.WINDEVENTS, V.ORDERSFEED, V.REGIONSNAP], "20240115", root, "change")
    rows = {r["select_table"]: r for r in out.collect()}
    assert rows["WINDEVENTS"]["row_count"] > 0 and rows["ORDERSFEED"]["table_empty"]
    assert rows["REGIONSNAP"]["row_count"] == 5
    assert read_audit(spark, root).count() == 3
    side = read_sidecar(spark, root).where("table_name = 'windevents'").orderBy("position").collect()
    assert side[-1]["column_name"] == LOAD_DATE and side[0]["date_column"] == "OPDATE"
    assert side[0]["primary_key"] == ["event_id"]


def test_failed_table_does_not_stop_the_run(spark, root):
    broken = V.WINDEVENTS.__class__(**{**V.WINDEVENTS.__dict__, "table_name": "broken",
                                       "original_table": "BROKEN",
                                       "source_sql": "SELECT * FROM no_such_view"})
    out = {r["select_table"]: r["status"] for r in
           load_all(spark, [broken, V.WINDEVENTS], "20240115", root, "change").collect()}
    assert out == {"BROKEN": "failed", "WINDEVENTS": "loaded"}


def test_failed_snapshot_job_keeps_old_snapshot(spark, root):
    from pyspark.errors import PySparkException
    write_snapshot(spark.range(5), root, "S2")
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom")))
                                 .otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        write_snapshot(bad, root, "S2")
    assert scan_snapshot_table(spark, root, "S2").count() == 5
