"""Reading the date test of a vendor's SQL text."""

import pytest

from dayload.vendor_sql import UnreadableSql, VendorSql, filled, spark_text


def found_in(sql):
    seen = VendorSql.read(filled(sql))
    return seen.plain, [(t.qualifier + t.column, seen.text[t.start:t.end], t.conjunct) for t in seen.tests]


@pytest.mark.parametrize("sql,plain,found", [
    ("SELECT * FROM t WHERE D = '%s'", True, [("D", "D = :load_date", True)]),
    ("select * from t where D >= %s order by 1", True, [("D", "D >= :load_date", True)]),
    ("SELECT * FROM [db].[t] [a] WHERE x = 'it''s -- AND D = ' AND [a].[D] = '%s'", True, [("[a].D", "[a].[D] = :load_date", True)]),
    ("SELECT * FROM t /* WHERE E = */ WHERE ((D = '%s')) AND (a + b) > 2", True, [("D", "D = :load_date", True)]),
    ("SELECT * FROM t WHERE convert(varchar(8), t.D, 112) = '%s' AND e BETWEEN 1 AND 2", True, [("t.D", "convert(varchar(8), t.D, 112) = :load_date", True)]),
    ("SELECT * FROM t WHERE D BETWEEN '%s' AND '%s 23:59' AND e = 1", True, [("D", "D BETWEEN :load_date AND concat(:load_date, ' 23:59')", True)]),
    ("SELECT * FROM t WHERE D = '%s' OR e = 1", True, [("D", "D = :load_date", False)]),
    ("SELECT * FROM t WHERE NOT (D = '%s') AND f = 2", True, [("D", "D = :load_date", False)]),
    ("SELECT max(D) FROM t WHERE D = '%s'", False, [("D", "D = :load_date", True)]),
    ("SELECT a FROM t WHERE a IN (SELECT a FROM u WHERE u.D = '%s')", True, [("u.D", "u.D = :load_date", False)]),
    ("SELECT a FROM t WHERE D = '%s' UNION ALL SELECT a FROM u WHERE u.D = '%s'", False, [("D", "D = :load_date", True), ("u.D", "u.D = :load_date", True)]),
    ("SELECT a FROM t JOIN u ON t.i = u.i AND u.D = '%s' WHERE left(t.x, 2) = 'ab'", True, [("u.D", "u.D = :load_date", False)]),
    ("SELECT * FROM t WHERE CASE WHEN a = 1 AND b = 2 THEN D ELSE E END = '%s' AND f = 1", True,
     [("a", "CASE WHEN a = 1 AND b = 2 THEN D ELSE E END = :load_date", False)] + [(c, "CASE WHEN a = 1 AND b = 2 THEN D ELSE E END = :load_date", False) for c in "bDE"]),
    ("SELECT * FROM t WHERE cast(D as varchar(8)) IN ('%s')", True, [("D", "cast(D as varchar(8)) IN (:load_date)", True)]),
])
def test_where_the_date_is_tested(sql, plain, found):
    assert found_in(sql) == (plain, found)


def test_swap_keeps_the_rest():
    text = filled("SELECT * FROM t WHERE (a.D = '%s' OR x LIKE '%%y') AND z %% 2 = 1 -- end")
    seen = VendorSql.read(text)
    assert seen.swapped("d", lambda t: t.on("NEW") + " = 5") == "SELECT * FROM t WHERE (a.NEW = 5 OR x LIKE '%y') AND z % 2 = 1 -- end"
    with pytest.raises(UnreadableSql):
        seen.swapped("E", lambda t: "")


@pytest.mark.parametrize("sql", ["SELECT 'a", "SELECT * FROM t WHERE (a = 1", "SELECT * FROM t) WHERE a = 1", "SELECT * FROM t WHERE a LIKE '%x'", "SELECT 5 % 2", "SELECT * FROM t WHERE AND b", "SELECT \x00"])
def test_unreadable(sql):
    with pytest.raises(UnreadableSql):
        VendorSql.read(filled(sql))


def test_text_for_a_session(spark):
    assert spark_text("SELECT [a b].\"c\", N'x' FROM [t]") == "SELECT `a b`.`c`, 'x' FROM `t`"
    spark.sql("SELECT TIMESTAMP_NTZ'2024-01-15 10:00:00' t, DATE'2024-01-15' d, '20240115' s, 20240115L i").createOrReplaceTempView("style")
    row = spark.sql(spark_text("SELECT convert(varchar(100), t, 112) t, convert(char(8), [d], 112) d, convert(varchar(9), s, 112) s, "
                               "convert(varchar(9), i, 112) i, convert(int, s) n, try_convert(date, 'x') x FROM style")).first()
    assert tuple(row) == ("20240115", "20240115", "20240115", "20240115", 20240115, None)
    for bad in ("SELECT convert(xml, a)", "SELECT convert(varchar(9), a, 120)", "SELECT convert(a)"):
        with pytest.raises(UnreadableSql):
            spark_text(bad)


def test_filters_on_top_are_pushed_down(spark):
    """A plain text keeps its change predicate typed and pushed into the scan; one inside a subquery too."""
    from conftest import SF_SMALL
    from dayload.catalog import specs_from_keyed
    from dayload.plans.load import load_plan
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").withColumnRenamed("o_orderdate", "ENTRYTIME").createOrReplaceTempView("pushed_orders")
    col = {"database_type": "bigint", "pandas_type": "int64", "parquet_type": "int64"}
    for sql in ("SELECT * FROM pushed_orders WHERE o_orderstatus = '%s'", "SELECT o_orderkey FROM (SELECT o_orderkey FROM pushed_orders p WHERE p.o_orderstatus = '%s') s"):
        spec, = specs_from_keyed({"t": {"sql": sql, "dynamic": True, "data_base": "x", "date_column": "o_orderstatus", "primary_key": ["o_orderkey"], "all_cols": {"o_orderkey": col}}})
        plan = load_plan(spark, spec, "19970515", "change")._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(o_orderdate,1997-05-15T00:00)" in plan
