"""Comparison properties, a brute-force check on a small fixture, and plan
shape."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from dayload.operators import reconcile as R
from dayload.operators.reconcile import NoKeyError, reconcile
from dayload.sources import vendor as V


def counts(rec):
    return rec.counts().collect()[0].asDict()


@pytest.fixture(scope="module")
def orders(spark):
    return V.read_table(spark, SF_MID, "orders")


def test_identical_loads_have_no_differences(spark, orders):
    c = counts(reconcile(orders, orders, ["o_orderkey"]))
    n = orders.count()
    assert c == {"rows_left": n, "rows_right": n, "rows_common": n, "rows_left_only": 0,
                 "rows_right_only": 0, "rows_all_equal": n, "rows_some_unequal": 0}


def test_partition_of_rows_and_swap(spark, orders):
    right = V.changed_orders(orders)
    a = counts(reconcile(orders, right, ["o_orderkey"]))
    b = counts(reconcile(right, orders, ["o_orderkey"]))
    assert a["rows_left_only"] + a["rows_common"] == a["rows_left"]
    assert a["rows_right_only"] + a["rows_common"] == a["rows_right"]
    assert (a["rows_left_only"], a["rows_right_only"]) == (b["rows_right_only"], b["rows_left_only"])
    assert a["rows_some_unequal"] == b["rows_some_unequal"]


def test_column_names_fold_case(spark, orders):
    upper = orders.toDF(*[c.upper() for c in orders.columns])
    c = counts(reconcile(upper, orders, ["O_ORDERKEY"]))
    assert c["rows_all_equal"] == orders.count()


def test_null_keys_match_each_other(spark):
    l = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k long, v double")
    r = spark.createDataFrame([(None, 1.0), (2, 2.0)], "k long, v double")
    c = counts(reconcile(l, r, ["k"]))
    assert (c["rows_common"], c["rows_left_only"], c["rows_right_only"]) == (1, 1, 1)


def test_no_key_is_refused(spark, orders):
    with pytest.raises(NoKeyError):
        reconcile(orders, orders, ["", " "])


def test_columns_and_samples(spark, orders):
    rec = reconcile(orders, V.changed_orders(orders), ["o_orderkey"])
    cols = {r["column"]: r for r in rec.columns().collect()}
    assert cols["o_totalprice"]["max_diff"] == pytest.approx(0.5)
    assert cols["o_orderpriority"]["null_diff"] == cols["o_orderpriority"]["unequal_cnt"] > 0
    assert cols["o_custkey"]["all_match"]
    sample = rec.sample_unequal().groupBy("column").count().collect()
    assert all(r["count"] <= 10 for r in sample)
    schema = {r["column"]: r for r in rec.schema().collect()}
    assert not schema["o_flag"]["in_left"] and schema["o_flag"]["in_right"]


def brute_force(left_rows, right_rows, key_idx):
    """Pair rows by (key, position among equal keys when sorted), count."""
    def numbered(rows):
        out = {}
        for row in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
            k = tuple(row[i] for i in key_idx)
            n = sum(1 for kk in out if kk[0] == k)
            out[(k, n)] = row
        return out
    L, Rr = numbered(left_rows), numbered(right_rows)
    common = set(L) & set(Rr)
    equal = sum(1 for k in common if L[k] == Rr[k])
    return {"rows_left": len(L), "rows_right": len(Rr), "rows_common": len(common),
            "rows_left_only": len(set(L) - common), "rows_right_only": len(set(Rr) - common),
            "rows_all_equal": equal, "rows_some_unequal": len(common) - equal}


@pytest.mark.parametrize("hot,block", [(R.HOT_GROUP_ROWS, R.BLOCK_ROWS), (3, 4), (1, 1)])
def test_duplicate_keys_against_brute_force(spark, hot, block):
    li = V.read_table(spark, SF_SMALL, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    right = li.where(F.col("l_partkey") % 7 != 0).withColumn(
        "l_quantity", F.when(F.col("l_partkey") % 5 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    got = counts(reconcile(li, right, ["l_orderkey", "l_linenumber"], hot_group_rows=hot, block_rows=block))
    assert got == brute_force([tuple(r) for r in li.collect()], [tuple(r) for r in right.collect()], (0, 1))


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_results_do_not_depend_on_the_split(spark, parts):
    """Same counts, columns, pairs and output columns for every bound and number of partitions."""
    li = V.read_table(spark, SF_SMALL, "lineitem").where("l_orderkey < 700")
    left, right = V.hot_lineitem(li), V.hot_lineitem(li, changed=True)
    keys = ["l_orderkey", "l_linenumber"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        want = None
        for hot, block in ((10**9, 10**6), (50, 10**6), (50, 13), (1, 5)):
            rec = reconcile(left, right, keys, hot_group_rows=hot, block_rows=block)
            got = (counts(rec), sorted(map(tuple, rec.columns().collect())), sorted(map(tuple, rec.status().collect())), rec.common().columns)
            want = want or got
            assert got == want, (hot, block)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_keys_of_two_types_become_one(spark):
    l = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "k long, v int")
    r = spark.createDataFrame([(1.0, 1), (1.5, 2), (2.0, 3)], "k double, v int")
    assert counts(reconcile(l, r, ["k"]))["rows_common"] == 2
    with pytest.raises(ValueError):
        reconcile(l, r.withColumn("k", F.lit("x")), ["k"])


def test_exact_values(spark):
    l = spark.createDataFrame([(1, 2**53, float("inf")), (2, 2**53 + 1, float("nan")), (3, 5, 1.0)], "k int, b long, d double")
    r = spark.createDataFrame([(1, 2**53 + 1, float("inf")), (2, 2**53 + 1, None), (3, 5, float("-inf"))], "k int, b long, d double")
    got = {x["column"]: x for x in reconcile(l, r, ["k"]).columns().collect()}
    assert (got["b"]["unequal_cnt"], got["b"]["max_diff"]) == (1, 1.0)
    assert (got["d"]["unequal_cnt"], got["d"]["max_diff"]) == (1, float("inf"))


def test_report_keeps_a_key_beyond_the_sampled_columns(spark):
    from dayload.plans.reconcile import read_report, write_report
    from dayload.session import scratch_dir
    cols = ", ".join(f"{i} as c{i}" for i in range(14))
    rec = reconcile(spark.sql(f"select {cols}, 1 as k"), spark.sql(f"select {cols}, 2 as k"), ["k"])
    log = scratch_dir(spark, "report-test")
    write_report(rec, log, "T", "20240115")
    assert {r["key"] for r in read_report(spark, log, "sample_one_sided").collect()} == {'{"k":1}', '{"k":2}'}


def test_wide_tables_unpivot_path(spark, orders, monkeypatch):
    right = V.changed_orders(orders)
    narrow = sorted(tuple(r) for r in reconcile(orders, right, ["o_orderkey"]).columns().collect())
    monkeypatch.setattr(R, "WIDE_COLUMNS", 2)
    wide = sorted(tuple(r) for r in reconcile(orders, right, ["o_orderkey"]).columns().collect())
    assert narrow == wide


@pytest.mark.parametrize("chunk,max_chunks", [(7, 100_000), (1, 2)])
def test_group_of_copies_against_brute_force(spark, monkeypatch, chunk, max_chunks):
    """One key holds a third of the rows as identical copies."""
    monkeypatch.setattr(R, "EXPAND_CHUNK", chunk)
    monkeypatch.setattr(R, "EXPAND_MAX_CHUNKS", max_chunks)
    base = [(k % 40, k % 3, float(k % 5), f"t{k % 2}") for k in range(120)]
    copies = [(99, 1, 1.0, "same")] * 60
    left_rows = base + copies + [(99, 1, 2.0, "other")]
    right_rows = base[::2] + copies[:45] + [(99, 1, 2.0, "other"), (99, 1, 0.5, "new")]
    schema = "k long, j long, v double, s string"
    l = spark.createDataFrame(left_rows, schema)
    r = spark.createDataFrame(right_rows, schema)
    rec = reconcile(l, r, ["k", "j"], hot_group_rows=2, block_rows=11)
    assert counts(rec) == brute_force(left_rows, right_rows, (0, 1))
    assert counts(reconcile(l, r, ["k", "j"])) == counts(rec)
    status = rec.status()
    assert status.count() == counts(rec)["rows_common"] + counts(rec)["rows_left_only"] + \
        counts(rec)["rows_right_only"]
    assert status.groupBy("k", "j", R.ORD).count().where("count > 1").count() == 0
    assert rec.left_only().count() == counts(rec)["rows_left_only"]


def test_report_sink_writes_sections_and_text(spark, orders):
    from dayload.plans.reconcile import read_report, write_report
    from dayload.session import scratch_dir
    rec = reconcile(orders, V.changed_orders(orders), ["o_orderkey"], left_name="df_load",
                    right_name="df_opdate")
    log = scratch_dir(spark, "report-test")
    paths = write_report(rec, log, "ORDERS", "20240115")
    write_report(rec, log, "ORDERS", "20240116")
    counts_rows = read_report(spark, log, "counts").collect()
    assert sorted(r["load_date"] for r in counts_rows) == ["20240115", "20240116"]
    text = "\n".join(r.value for r in spark.read.text(paths["text"]).collect())
    assert "only in df_opdate: 1 ['o_flag']" in text and "o_totalprice" in text


def test_weighted_path_plans_stay_small(spark, lineitem_small=None):
    """Samples and row outputs over collapsed runs on a 9-column table plan
    and run (constraint inference would exhaust the heap here)."""
    li = V.read_table(spark, SF_SMALL, "lineitem")
    rec = reconcile(V.hot_lineitem(li), V.hot_lineitem(li, changed=True),
                    ["l_orderkey", "l_linenumber"], hot_group_rows=50)
    c = counts(rec)
    assert rec.sample_unequal().count() <= 10 * len(rec.compare)
    assert rec.left_only().count() == c["rows_left_only"]
    assert rec.common().count() == c["rows_common"]
