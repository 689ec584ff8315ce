import json

from conftest import SF_SMALL
from dayload.__main__ import main
from dayload.catalog import catalog_frame
from dayload.session import scratch_dir
from dayload.sources import vendor as V


def test_load_and_reconcile_from_the_command_line(spark, tmp_path):
    V.register_vendor_views(spark, SF_SMALL)
    cat = tmp_path / "catalog.json"
    cat.write_text(json.dumps([r.asDict(recursive=True)
                               for r in catalog_frame(spark, V.demo_catalog()).collect()]))
    left, right, log = (scratch_dir(spark, n) for n in ("cli-l", "cli-r", "cli-log"))
    a = main(["load", "--catalog", str(cat), "--root", left, "--date", "20240115",
              "--profile", "business"], spark)
    b = main(["load", "--catalog", str(cat), "--root", right, "--date", "20240115"], spark)
    assert {r["select_table"] for r in a} == {r["select_table"] for r in b} == {"WINDEVENTS", "ORDERSFEED"}
    out = {r["table_name"]: r for r in main(["reconcile", "--catalog", str(cat), "--left", left,
                                              "--right", right, "--log", log, "--date", "20240115",
                                              "--abs-tol", "0.0", "--rel-tol", "0.0"], spark)}
    assert out["WINDEVENTS"]["status"] == "compared" and out["ORDERSFEED"]["status"] == "missing"
    need = tmp_path / "need.json"
    need.write_text(json.dumps({"need_tables": ["nationsnap"]}))
    c = main(["load", "--catalog", str(cat), "--root", left, "--tables", str(need), "--profile", "v1"], spark)
    assert [r["select_table"] for r in c] == ["NATIONSNAP"] and c[0]["row_count"] == 25


def test_a_failed_table_fails_the_run_after_all_were_tried(spark, tmp_path):
    from dayload.__main__ import exit_code
    from dayload.catalog import TableSpec
    V.register_vendor_views(spark, SF_SMALL)
    broken = TableSpec("broken", "x", "BROKEN", "SELECT *\nFROM no_such_table", True, True, "D", ("k",))
    cat = tmp_path / "catalog.json"
    cat.write_text(json.dumps([r.asDict(recursive=True) for r in catalog_frame(spark, [broken, V.WINDEVENTS]).collect()]))
    rows = main(["load", "--catalog", str(cat), "--root", scratch_dir(spark, "cli-f"), "--date", "20240115"], spark)
    assert {r["select_table"]: r["status"] for r in rows} == {"BROKEN": "failed", "WINDEVENTS": "loaded"}
    assert exit_code(rows) == 1 and exit_code([r for r in rows if r["status"] == "loaded"]) == 0
    assert "no_such_table" in next(r["error"] for r in rows if r["status"] == "failed")


def test_connection_and_column_type_files(spark, tmp_path):
    from dataclasses import replace
    from dayload.__main__ import with_column_types
    from dayload.sources.query import read_connections
    (tmp_path / "c.json").write_text(json.dumps({"wind": {"url": "jdbc:x://h/db", "user": "u", "fetchsize": 7}}))
    opts = read_connections(spark, str(tmp_path / "c.json"))["wind"].options("SELECT 1")
    assert opts == {"url": "jdbc:x://h/db", "fetchsize": "7", "preferTimestampNTZ": "true", "user": "u", "query": "SELECT 1"}
    (tmp_path / "windevents.json").write_text(json.dumps({"event_id": {"database_type": "bigint", "pandas_type": "int64", "parquet_type": "int64"}}))
    bare = replace(V.WINDEVENTS, all_cols=())
    assert [c.name for c in with_column_types(spark, bare, str(tmp_path)).all_cols] == ["event_id"]
    assert with_column_types(spark, V.WINDEVENTS, str(tmp_path)) is V.WINDEVENTS
