import pytest

from conftest import SF_SMALL
from dayload.sources import vendor as V
from dayload.sources.query import JdbcSource, scan_sql_query


def test_jdbc_plain_query_options():
    opts = JdbcSource(url="jdbc:sqlserver://h;databaseName=db", user="u", password="p",
                      fetchsize=5000).options("SELECT * FROM T WHERE D = '20240115'")
    assert opts["query"].startswith("SELECT") and opts["fetchsize"] == "5000"
    assert "partitionColumn" not in opts and "dbtable" not in opts


def test_jdbc_partitioned_read_uses_dbtable():
    src = JdbcSource(url="jdbc:x", partition_column="ID", lower_bound=0, upper_bound=10_000_000,
                     num_partitions=64)
    opts = src.options("SELECT * FROM T")
    assert opts["dbtable"] == "(SELECT * FROM T) src" and "query" not in opts
    assert (opts["partitionColumn"], opts["numPartitions"]) == ("ID", "64")
    with pytest.raises(ValueError):
        JdbcSource(url="jdbc:x", partition_column="ID").options("SELECT 1")


def test_sql_scan_binds_the_date(spark):
    V.register_vendor_views(spark, SF_SMALL)
    q = "SELECT count(*) AS n FROM vendor_windevents WHERE TRADE_DT = :load_date"
    n = scan_sql_query(spark, q, "20240115").collect()[0]["n"]
    m = spark.table("vendor_windevents").where("TRADE_DT = '20240115'").count()
    assert n == m and n > 0
    assert scan_sql_query(spark, "SELECT 1 AS x").collect()[0]["x"] == 1


def test_source_frame_routes_by_vendor(spark, monkeypatch):
    from dayload.sources import query as Q
    seen = {}

    def fake_scan(self, spark_, sql):
        seen["sql"] = sql
        return spark_.range(1)

    monkeypatch.setattr(Q.JdbcSource, "scan", fake_scan)
    spec = V.WINDEVENTS.__class__(**{**V.WINDEVENTS.__dict__,
                                     "source_sql": "SELECT * FROM T WHERE D >= :load_date"})
    conns = {"wind": JdbcSource(url="jdbc:x")}
    Q.source_frame(spark, spec, "20240115", conns)
    assert seen["sql"] == "SELECT * FROM T WHERE D >= '20240115'"
    V.register_vendor_views(spark, SF_SMALL)
    assert Q.source_frame(spark, V.WINDEVENTS, "20240115", {"other": JdbcSource(url="jdbc:y")}).count() > 0


def test_jdbc_bounds_from_the_source(spark, monkeypatch):
    from dayload.sources import query as Q
    asked = []

    def fake_scan(self, spark_, sql):
        asked.append((sql, self.partition_column))
        return spark_.createDataFrame([(5, 905)], "lo long, hi long")

    monkeypatch.setattr(Q.JdbcSource, "scan", fake_scan)
    src = JdbcSource(url="jdbc:x", partition_column="ID", num_partitions=8).with_bounds(spark, "SELECT * FROM T")
    assert (src.lower_bound, src.upper_bound) == (5, 905)
    assert asked == [("SELECT MIN(ID) AS lo, MAX(ID) AS hi FROM (SELECT * FROM T) b", None)]
    assert src.options("SELECT * FROM T")["numPartitions"] == "8"
