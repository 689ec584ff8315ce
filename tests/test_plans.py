"""Physical plan shapes that matter at scale."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dayload.operators import reconcile as R
from dayload.plans.load import load_plan
from dayload.sources import vendor as V


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return V.read_table(spark, SF_SMALL, "lineitem")


def test_load_plan_has_no_shuffle(spark):
    V.register_vendor_views(spark, SF_SMALL)
    for by in ("change", "business", "v1"):
        spec = V.ORDERSFEED if by == "v1" else V.WINDEVENTS
        p = plan(load_plan(spark, spec, "20240115", by))
        assert "Exchange" not in p and p.count("FileScan parquet") == 1


def test_one_exchange_pairs_any_key(spark, lineitem):
    orders = V.read_table(spark, SF_SMALL, "orders")
    for l, r, keys in ((orders, V.changed_orders(orders), ["o_orderkey"]),
                       (lineitem, lineitem.where("l_partkey % 3 != 0"), ["l_orderkey", "l_linenumber"])):
        p = plan(R.reconcile(l, r, keys).stats())
        assert p.count("Exchange hashpartitioning") == 1
        assert "Join" not in p and "Broadcast" not in p


def test_building_a_comparison_starts_no_job_and_leaves_the_session_alone(spark, lineitem):
    key = "spark.sql.constraintPropagation.enabled"
    before, tracker = spark.conf.get(key, None), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "building a comparison")
    rec = R.reconcile(lineitem, lineitem, ["l_orderkey", "l_linenumber"], hot_group_rows=2)
    rec.schema()
    shape = rec.shape()
    assert not tracker.getJobIdsForGroup("lazy")
    assert "Join" not in plan(shape) and "Window" not in plan(shape)
    assert spark.conf.get(key, None) == before
    spark.sparkContext.setJobGroup("", "")


def test_hot_keys_collapse_copies_before_the_shuffle(spark, lineitem):
    left = V.hot_lineitem(lineitem)
    rec = R.reconcile(left, left, ["l_orderkey", "l_linenumber"], hot_group_rows=100)
    p = plan(rec.stats())
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_samples_are_partial_top_k(spark):
    orders = V.read_table(spark, SF_SMALL, "orders")
    p = plan(R.reconcile(orders, V.changed_orders(orders), ["o_orderkey"]).sample_unequal())
    assert "WindowGroupLimit" in p and "Partial" in p
    p1 = plan(R.reconcile(orders, V.changed_orders(orders), ["o_orderkey"]).sample_one_sided("left"))
    assert "TakeOrderedAndProject" in p1


def test_expansion_spreads_long_runs(spark, lineitem):
    rec = R.reconcile(lineitem, lineitem, ["l_orderkey", "l_linenumber"], hot_group_rows=1)
    p = plan(rec.status())
    assert "RoundRobinPartitioning" in p


def test_tasks_that_sort_rows_grow_with_the_loads(spark, lineitem, monkeypatch):
    monkeypatch.setattr(R, "TASK_CELLS", 2000)
    keys, own = ["l_orderkey", "l_linenumber"], int(spark.conf.get("spark.sql.shuffle.partitions"))
    changed = lineitem.withColumn("l_tax", F.col("l_tax") + 1)
    seen = []
    for left in (lineitem.where("l_orderkey % 2 = 0"), lineitem):
        rec = R.reconcile(left, changed, keys)
        rows, columns = sum(df.count() for df in (left, changed)), len(left.columns)
        seen.append(-(-rows * (columns + 2) // R.TASK_CELLS))
        assert f", {seen[-1]}), REPARTITION_BY_NUM" in plan(rec.stats())
    assert own < seen[0] < seen[1]


def test_keys_of_one_task_are_bounded_and_pairs_stay(spark, lineitem, monkeypatch):
    k = (F.col("l_orderkey") % 3).alias("k")
    left, right = lineitem.select(k, "l_tax", "l_partkey"), lineitem.where("l_partkey % 7 <> 0").select(k, "l_tax", "l_suppkey")
    want = [(c.counts().first(), c.columns().collect()) for c in (R.reconcile(left, right, ["k"], hot_group_rows=h) for h in (10 ** 9, 50))]
    monkeypatch.setattr(R, "TASK_CELLS", 500)
    rec = R.reconcile(left, right, ["k"], hot_group_rows=50, block_rows=70)
    assert [(rec.counts().first(), rec.columns().collect())] * 2 == want
    assert "REPARTITION_BY_NUM" in plan(rec.stats())
    # what a task may sort of one key, in the cells of a narrow row
    assert 2 * R.HOT_GROUP_ROWS * 4 <= 4_000_000 and 4 * R.BLOCK_ROWS * 4 <= 4_000_000
