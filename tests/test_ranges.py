"""Digests of key ranges, and one order of shared values for both ways of pairing."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dayload.operators import reconcile as R
from dayload.operators.reconcile import reconcile
from dayload.sources import vendor as V

NUMBERS = [0.0, -0.0, float("nan"), None, float("inf"), float("-inf"), 1.0, 2.5, -3.0]
WHOLE = [0, 1, -3, None, 7]
KINDS = {"double": NUMBERS, "float": NUMBERS, "long": WHOLE, "int": WHOLE, "decimal(10,2)": [None if v is None else Decimal(v) for v in WHOLE],
         "decimal(38,2)": [None if v is None else Decimal(v) for v in WHOLE], "string": ["0.0", "NaN", None, "1", "-0.0", "Infinity"],
         "date": [dt.date(2024, 1, 1), None, dt.date(1970, 1, 1)]}
PAIRS = [("double", "float"), ("double", "long"), ("float", "string"), ("double", "double"), ("decimal(38,2)", "long"), ("date", "string")]


def pair(spark, a, b, seed, n=60):
    """Few keys, so most repeat; one column of kind a on the left and b on the right, one of its own on each side."""
    rng = np.random.default_rng(seed)

    def side(kind, own):
        values = KINDS[kind]
        rows = [(int(rng.integers(0, 4)), values[rng.integers(len(values))], int(rng.integers(0, 2))) for _ in range(n)]
        return spark.createDataFrame(rows, f"k int, v {kind}, {own} int")
    return side(a, "x"), side(b, "y")


def told(rec):
    pairs = [(r["k"], r["__ord"], r["_merge"]) for r in rec.status().collect()]
    values = sorted(str((r["k"], r["__ord"], r["v_match"])) for r in rec.common().collect())
    return rec.counts().first(), rec.columns().collect(), sorted(pairs), values


@pytest.mark.parametrize("a,b", PAIRS[:3])
def test_every_bound_gives_the_same_pairs(spark, a, b):
    left, right = pair(spark, a, b, PAIRS.index((a, b)))
    want = told(reconcile(left, right, ["k"]))
    assert told(reconcile(left, right, ["k"], hot_group_rows=5, block_rows=3)) == want


@pytest.mark.parametrize("a,b", PAIRS[3:])
def test_every_bound_gives_the_same_counts(spark, a, b):
    left, right = pair(spark, a, b, 100 + PAIRS.index((a, b)))
    got = [(c.counts().first(), c.columns().collect()) for c in (reconcile(left, right, ["k"], hot_group_rows=h) for h in (10 ** 9, 2))]
    assert got[0] == got[1]


def whole(rec):
    """The same comparison with all rows paired."""
    found = rec.ranges()
    rec._ranges = R.Ranges(0, list(range(1 << rec.leaf_bits)), found.heavy, 1)
    assert rec._ranges.whole and rec._agreeing == 0
    return rec


@pytest.mark.parametrize("tol,hot", [(0.2, 10 ** 9), (0.0, 3)])
def test_ranges_change_no_output(spark, tol, hot):
    orders = V.read_table(spark, SF_SMALL, "orders")
    right = V.changed_orders(orders).unionByName(V.changed_orders(orders).where("o_orderkey % 40 < 8"))
    left = orders.union(orders.where("o_orderkey % 50 < 8"))

    def out(rec):
        return [sorted(map(str, f.collect())) for f in (rec.counts(), rec.columns(), rec.left_only(), rec.right_only(), rec.status(), rec.sample_unequal(keep_rank=True),
                                                        rec.sample_one_sided_json("left"), rec.sample_one_sided_json("right"))]
    fast = reconcile(left, right, ["o_orderkey"], abs_tol=tol, hot_group_rows=hot)
    assert not fast.ranges().whole and fast.ranges().equal_rows > 0
    assert out(fast) == out(whole(reconcile(left, right, ["o_orderkey"], abs_tol=tol, hot_group_rows=hot)))


def test_loads_that_agree_are_only_summed_up(spark):
    li = V.read_table(spark, SF_SMALL, "lineitem")
    rec = reconcile(li, li.orderBy(F.desc("l_tax")), ["l_orderkey", "l_linenumber"])
    plan = rec.stats()._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and not any(x in plan for x in ("Join ", "Window [", "parquet"))
    c = rec.counts().first()
    assert c["rows_all_equal"] == c["rows_left"] == c["rows_right"] == li.count() and c["rows_some_unequal"] == 0
    assert {r["match_cnt"] for r in rec.columns().collect()} == {li.count()}
    digests = rec.digests()._jdf.queryExecution().executedPlan().toString()
    assert digests.count("Exchange hashpartitioning") == 1 and "partial_" in digests


def test_swapped_missing_values_and_repeats_are_seen(spark):
    """What a plain hash or a sum without sign takes for equal."""
    l = spark.createDataFrame([(1, None, 5), (2, 1, 1), (2, 1, 1), (3, 1, 2), (3, 2, 1)], "k int, a int, b int")
    r = spark.createDataFrame([(1, 5, None), (2, 2, 2), (2, 2, 2), (3, 1, 1), (3, 2, 2)], "k int, a int, b int")
    c = reconcile(l, r, ["k"]).counts().first()
    assert (c["rows_common"], c["rows_all_equal"]) == (5, 0)
    n = reconcile(l.withColumn("k", F.lit(None).cast("int")), l.withColumn("k", F.lit(None).cast("int")), ["k"]).counts().first()
    assert n["rows_all_equal"] == 5


def test_sums_that_overflow_count_as_different(spark, monkeypatch):
    l = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    rec = reconcile(l, l, ["k"])
    digests = rec.digests().withColumn("d0", F.lit(None).cast("long"))
    monkeypatch.setattr(R.Reconciliation, "digests", lambda self: digests)
    assert rec.ranges().equal_rows == 0 and rec.counts().first()["rows_all_equal"] == 50


def test_hot_keys_are_looked_for_in_heavy_ranges_only(spark):
    l = spark.range(300).select(F.when(F.col("id") < 100, F.lit(7)).otherwise(F.col("id")).alias("k"), (F.col("id") % 3).alias("v"))
    rec = reconcile(l, l.withColumn("v", F.col("v") + 1), ["k"], hot_group_rows=50)
    found = rec.ranges()
    assert len(found.heavy) == 1
    hot = rec._hot_keys(found.heavy)
    assert [r[0] for r in hot.collect()] == [7] and rec._hot_keys([]) is None
    assert rec.counts().first()["rows_common"] == 300


def test_more_ranges_than_allowed(spark):
    l = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        reconcile(l, l, ["k"], leaf_bits=21)
    assert reconcile(l, l.where("k < 2"), ["k"], leaf_bits=20).counts().first()["rows_left_only"] == 1
