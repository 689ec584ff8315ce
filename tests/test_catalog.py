import json
import os
import tempfile

import pytest
from pyspark.errors import PySparkException

from dayload.catalog import (KEY_REGISTRY, UnknownTableError, catalog_columns, catalog_frame,
                             primary_key_for, primary_key_of, read_catalog, registry_frame,
                             resolve_table_name, select_tables_flagged, select_tables_listed,
                             specs_of)
from dayload.sources.vendor import demo_catalog


def test_registry_shape():
    assert len(KEY_REGISTRY) == 66
    assert KEY_REGISTRY["cfuturescalendar"] == []


def test_primary_key_lookup():
    assert primary_key_for("AINDEXEODPRICES") == ["S_INFO_WINDCODE", "TRADE_DT"]
    assert primary_key_for("ashareplantrade") == ["S_INFO_WINDCODE", "ANN_DT", "ANN_DT_NEW"]
    assert primary_key_for("rpt_rating_adjust") == ["stock_code"]
    assert primary_key_for("cfuturescalendar") == []
    assert primary_key_for("anything", ("a", "", "b")) == ["a", "b"]
    with pytest.raises(UnknownTableError):
        primary_key_for("no_such_table")


def test_catalog_json_round_trip(spark):
    specs = demo_catalog()
    d = tempfile.mkdtemp()
    path = os.path.join(d, "catalog.json")
    cat = catalog_frame(spark, specs)
    with open(path, "w") as f:
        json.dump([r.asDict(recursive=True) for r in cat.collect()], f)
    back = read_catalog(spark, path)
    assert [s.table_name for s in specs_of(back)] == [s.table_name for s in specs]
    assert specs_of(back) == specs


def test_catalog_operators(spark):
    cat = catalog_frame(spark, demo_catalog())
    cols = catalog_columns(cat).where("table_name = 'windevents'").orderBy("position").collect()
    assert [r["name"] for r in cols][:3] == ["event_id", "OPDATE", "OPMODE"]
    flagged = {r["table_name"] for r in select_tables_flagged(cat).collect()}
    assert flagged == {"windevents", "ordersfeed"}
    names = spark.createDataFrame([("nationsnap",), ("nope",)], "table_name string")
    assert [r["table_name"] for r in select_tables_listed(cat, names).collect()] == ["nationsnap"]
    orig = {r["table_name"]: r["original_table"] for r in resolve_table_name(cat).collect()}
    assert orig["windevents"] == "WINDEVENTS"
    keys = {r["table_name"]: r["primary_key"] for r in primary_key_of(cat, registry_frame(spark)).collect()}
    assert keys["lineitemfeed"] == ["l_orderkey"] and keys["regionsnap"] == []


def test_primary_key_of_registry_and_unknown(spark):
    reg = registry_frame(spark)
    cat = spark.createDataFrame([("AIndexEODPrices", None)], "table_name string, primary_key array<string>")
    assert primary_key_of(cat, reg).collect()[0]["primary_key"] == ["S_INFO_WINDCODE", "TRADE_DT"]
    unknown = spark.createDataFrame([("mystery", None)], "table_name string, primary_key array<string>")
    with pytest.raises(PySparkException):
        primary_key_of(unknown, reg).collect()


def test_keyed_catalog_and_table_list(spark, tmp_path):
    from dayload.catalog import read_keyed_catalog, read_table_list
    from dayload.plans.load import load_plan
    from dayload.sources import vendor as V
    from conftest import SF_SMALL
    keyed = {
        "windevents": {
            "sql": "SELECT * FROM vendor_windevents WHERE TRADE_DT = '%s'",
            "dynamic": True, "data_base": "wind", "original_table": "WINDEVENTS",
            "date_column": "TRADE_DT", "is_important": True, "primary_key": ["event_id"],
            "all_cols": {"event_id": {"database_type": "bigint", "pandas_type": "int64", "parquet_type": "int64"},
                         "OPDATE": {"database_type": "datetime", "pandas_type": "int64", "parquet_type": "int64"},
                         "TRADE_DT": {"database_type": "varchar", "pandas_type": "str", "parquet_type": "string"}}},
        "nationsnap": {"sql": "SELECT * FROM vendor_nationsnap", "dynamic": False, "data_base": "x",
                       "oraignal_table": "NATIONSNAP", "date_where": "OPDATE",
                       "all_columns": {"n_nationkey": {"database_type": "int", "pandas_type": "int64",
                                                       "parquet_type": "int64"}}},
    }
    (tmp_path / "cat.json").write_text(json.dumps(keyed))
    (tmp_path / "need.json").write_text(json.dumps({"need_tables": ["nationsnap"]}))
    specs = {s.table_name: s for s in read_keyed_catalog(spark, str(tmp_path / "cat.json"))}
    assert [c.name for c in specs["windevents"].all_cols] == ["event_id", "OPDATE", "TRADE_DT"]
    assert specs["windevents"].source_sql.endswith("TRADE_DT = :load_date")
    assert specs["nationsnap"].original_table == "NATIONSNAP"
    assert read_table_list(spark, str(tmp_path / "need.json")) == ["nationsnap"]
    V.register_vendor_views(spark, SF_SMALL)
    out = load_plan(spark, specs["windevents"], "20240115", "business")
    assert out.count() == spark.table("vendor_windevents").where("TRADE_DT = '20240115'").count()
    # a change-date load filters on the change date alone, whatever date its SQL tests
    from dayload.operators.filters import incremental_filter
    changed = incremental_filter(spark.table("vendor_windevents"), V.WINDEVENTS, "20240115", "change")
    assert load_plan(spark, specs["windevents"], "20240115", "change").count() == changed.count()


def keyed(sql, name="windevents"):
    col = {"database_type": "bigint", "pandas_type": "int64", "parquet_type": "int64"}
    return {name: {"sql": sql, "dynamic": True, "data_base": "wind", "date_column": "TRADE_DT", "primary_key": ["event_id"], "all_cols": {"event_id": col}}}


@pytest.mark.parametrize("sql", ["SELECT * FROM vendor_windevents", "SELECT * FROM vendor_windevents WHERE event_id > '%s'", "SELECT * FROM vendor_windevents WHERE TRADE_DT = '%d'",
                                 "SELECT * FROM vendor_windevents WHERE (TRADE_DT = '%s'", "SELECT * FROM vendor_windevents WHERE TRADE_DT = '%s"])
def test_an_entry_that_cant_be_swapped_fails_alone(spark, sql):
    """Its change-date load is an audit row of its own; the table beside it loads."""
    from dayload.catalog import specs_from_keyed
    from dayload.plans.load import load_all
    from dayload.session import scratch_dir
    from dayload.sources import vendor as V
    from conftest import SF_SMALL
    V.register_vendor_views(spark, SF_SMALL)
    good = "SELECT * FROM vendor_windevents WHERE TRADE_DT = '%s'"
    specs = specs_from_keyed(keyed(sql, "odd") | keyed(good))
    rows = {r["select_table"]: r for r in load_all(spark, specs, "20240115", scratch_dir(spark, "alone"), "change").collect()}
    assert rows["windevents"]["status"] == "loaded" and rows["windevents"]["row_count"] > 0
    if "WHERE" in sql:  # a text without any date is filtered on the change date alone
        assert rows["odd"]["status"] == "failed" and rows["odd"]["error"]
    else:
        assert rows["odd"]["row_count"] == rows["windevents"]["row_count"]


def test_business_load_needs_no_date_column_in_its_select_list(spark):
    from dayload.catalog import specs_from_keyed
    from dayload.plans.load import load_plan
    from dayload.sources import vendor as V
    from conftest import SF_SMALL
    V.register_vendor_views(spark, SF_SMALL)
    col = {"database_type": "bigint", "pandas_type": "int64", "parquet_type": "int64"}
    spec, = specs_from_keyed({"windevents": {"sql": "SELECT e.event_id FROM vendor_windevents e WHERE e.TRADE_DT = '%s' AND 1 < 2", "dynamic": True,
                                             "data_base": "wind", "date_column": "TRADE_DT", "primary_key": ["event_id"], "all_cols": {"event_id": col}}})
    want = spark.table("vendor_windevents").where("TRADE_DT = '20240115'").count()
    assert load_plan(spark, spec, "20240115", "business").count() == want
