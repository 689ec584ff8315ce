from conftest import SF_SMALL
from dayload.plans.load import load_all
from dayload.plans.reconcile import reconcile_all
from dayload.session import scratch_dir
from dayload.sources import vendor as V


def test_statuses_of_a_daily_comparison(spark):
    """Compared, missing on one side, and no key (blank-only key)."""
    V.register_vendor_views(spark, SF_SMALL)
    specs = [V.WINDEVENTS, V.ORDERSFEED, V.REGIONSNAP, V.NATIONSNAP]
    left, right = scratch_dir(spark, "all-l"), scratch_dir(spark, "all-r")
    load_all(spark, [V.WINDEVENTS, V.REGIONSNAP, V.NATIONSNAP], "20240115", left, "business")
    load_all(spark, specs, "20240115", right, "change")
    out = {r["table_name"]: r for r in reconcile_all(spark, specs, "20240115", left, right).collect()}
    assert out["WINDEVENTS"]["status"] == "compared"
    assert out["ORDERSFEED"]["status"] == "missing"       # empty day on both sides
    assert out["REGIONSNAP"]["status"] == "no_key"
    assert out["NATIONSNAP"]["status"] == "compared"
    assert out["NATIONSNAP"]["rows_all_equal"] == 25


def test_store_never_loaded(spark):
    V.register_vendor_views(spark, SF_SMALL)
    left, right = scratch_dir(spark, "none-l"), scratch_dir(spark, "none-r")
    load_all(spark, [V.WINDEVENTS], "20240115", right, "change")
    out = {r["table_name"]: r["status"]
           for r in reconcile_all(spark, [V.WINDEVENTS], "20240115", left, right).collect()}
    assert out == {"WINDEVENTS": "missing"}


def test_stores_of_the_first_loader_are_compared(spark):
    """They lie under the catalog's table name; a mixed pair is compared too."""
    from dayload.plans.load import load_all
    from dayload.plans.reconcile import reconcile_all
    from dayload.session import scratch_dir
    from dayload.sources import vendor as V
    from conftest import SF_SMALL
    V.register_vendor_views(spark, SF_SMALL)
    a, b, c = (scratch_dir(spark, "v1") for _ in range(3))
    for root, profile in ((a, "v1"), (b, "v1"), (c, "business")):
        load_all(spark, [V.ORDERSFEED], V.OTHER_LOAD_DATE, root, profile)
    for right in (b, c):
        row, = reconcile_all(spark, [V.ORDERSFEED], V.OTHER_LOAD_DATE, a, right).collect()
        assert row["status"] == "compared" and row["rows_common"] == row["rows_left"] == row["rows_right"] > 0
