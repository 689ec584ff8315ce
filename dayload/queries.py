"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator or pipeline.  Every query reads the driver's tables in ``sf_dir``
whole (through the vendor views) and returns a DataFrame; sink queries
write under the session's checkpoint folder and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import catalog_frame, select_tables_flagged, select_tables_listed, specs_from_keyed, specs_of
from .functions.cast import cast_declared, check_write_schema
from .functions.compare import values_equal
from .functions.fill import fill_float, fill_int, fill_string
from .functions.timefmt import change_day_int, day_text, load_date_of, to_epoch_seconds
from .operators import filters as FL
from .operators.project import add_load_date, project_declared, project_tolerant
from .operators.reconcile import duplicate_keys, reconcile
from .plans.load import flagged, load_all, load_table, stored_name
from .plans.reconcile import read_report, reconcile_all, reconcile_day, write_report
from .session import scratch_dir
from .sinks.writers import read_audit, read_sidecar, write_snapshot
from .sources import vendor as V
from .sources.chunked import scan_chunks
from .sources.query import scan_sql_query
from .sources.store import comparable_tables, list_loaded_tables, scan_load_date, scan_snapshot_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


W, O = V.WIND_LOAD_DATE, V.OTHER_LOAD_DATE
NEXT_W = "20240116"
EMPTY_DAY = "20300101"
AUDIT_COLS = ["load_date", "select_table", "table_path", "table_empty", "dynamic",
              "date_column", "row_count", "status", "profile"]


def _views(spark: SparkSession, sf_dir: str) -> None:
    V.register_vendor_views(spark, sf_dir)


def _view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _views(spark, sf_dir)
    return spark.table(f"vendor_{name}")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return V.read_table(spark, sf_dir, name)


def _dtype(df: DataFrame, c: str) -> T.DataType:
    return df.schema[c].dataType


# ---------------------------------------------------------------------------
# pipelines
# ---------------------------------------------------------------------------
@query("daily_load_change")
def daily_load_change(spark, sf_dir):
    """Flagship: load the wind change log for one day by change date."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_change")
    load_table(spark, V.WINDEVENTS, W, root, "change")
    return scan_load_date(spark, root, V.WINDEVENTS.original_table, W)


@query("daily_load_business")
def daily_load_business(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_business")
    load_table(spark, V.WINDEVENTS, W, root, "business")
    return scan_load_date(spark, root, V.WINDEVENTS.original_table, W)


@query("daily_load_v1")
def daily_load_v1(spark, sf_dir):
    """First loader: business date, every declared column required, change
    time kept as epoch seconds, no LOAD_DATE in the rows."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_v1")
    load_table(spark, V.ORDERSFEED, O, root, "v1")
    return scan_load_date(spark, root, stored_name(V.ORDERSFEED, "v1"), O, keep_load_date=False)


# Kept as the daily loaders keep them: every incremental SQL carries its own date test.
KEYED = {spec.table_name: {
    "sql": f"SELECT * FROM vendor_{spec.table_name} WHERE {spec.date_column} = '%s'", "dynamic": True, "data_base": spec.data_base,
    "original_table": spec.original_table, "date_column": spec.date_column, "is_important": True, "primary_key": list(spec.primary_key or ()),
    "all_cols": {c.name: {"database_type": c.database_type, "pandas_type": c.logical_type, "parquet_type": c.parquet_type} for c in spec.all_cols}}
    for spec in (V.WINDEVENTS, V.ORDERSFEED)}


def _keyed_load(spark, sf_dir, profile):
    """A wind table and another vendor's, loaded from a kept catalog; key and load date of the stored rows."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "keyed")
    wind, other = specs_from_keyed(KEYED)
    load_all(spark, [wind], W, root, profile)
    load_all(spark, [other], O, root, profile)
    parts = [scan_load_date(spark, root, s.original_table, day).select(
        F.lit(s.table_name).alias("table_name"), F.col(key).cast("long").alias("key"), F.col("LOAD_DATE").cast("long").alias("load_date"))
        for s, day, key in ((wind, W, "event_id"), (other, O, "o_orderkey"))]
    return parts[0].unionByName(parts[1])


@query("keyed_load_change")
def q_keyed_load_change(spark, sf_dir):
    return _keyed_load(spark, sf_dir, "change")


@query("keyed_load_business")
def q_keyed_load_business(spark, sf_dir):
    return _keyed_load(spark, sf_dir, "business")


# How kept SQL texts may test their date: (query, business rows, change rows) by form; both as conditions on the source.
_ON_DAY = "CAST(OPDATE AS DATE) = DATE '2024-01-15' AND (OPMODE = '0' OR OPMODE = '1' AND TRADE_DT >= '20240115')"
KEYED_FORMS = {
    "range": ("SELECT * FROM vendor_windevents WHERE TRADE_DT >= '%s'", "TRADE_DT >= '20240115'", _ON_DAY),
    "brackets": ("SELECT [e].* FROM [vendor_windevents] [e] WHERE [e].[TRADE_DT] = '%s' -- the day", "TRADE_DT = '20240115'", _ON_DAY),
    "convert": ("SELECT * FROM vendor_windevents WHERE convert(varchar(100), TRADE_DT, 112) = '%s'", "TRADE_DT = '20240115'", _ON_DAY),
    "convert_time": ("SELECT * FROM vendor_windevents WHERE convert(varchar(100), OPDATE, 112) = '%s'", "CAST(OPDATE AS DATE) = DATE '2024-01-15'", None),
    "between": ("SELECT * FROM vendor_windevents w WHERE w.event_id %% 2 = 0 AND w.TRADE_DT BETWEEN '%s' AND '%s' AND w.value_txt LIKE '%%i%%'",
                "TRADE_DT = '20240115' AND event_id % 2 = 0 AND value_txt LIKE '%i%'", f"{_ON_DAY} AND event_id % 2 = 0 AND value_txt LIKE '%i%'"),
    "either": ("SELECT * FROM vendor_windevents WHERE (TRADE_DT = '%s' OR event_id < 50) AND NOT user_id IS NULL",
               "(TRADE_DT = '20240115' OR event_id < 50) AND user_id IS NOT NULL", f"({_ON_DAY} OR event_id < 50) AND user_id IS NOT NULL"),
    "subquery": ("SELECT s.event_id, s.value_num FROM (SELECT event_id, value_num FROM vendor_windevents x WHERE x.TRADE_DT = '%s') s WHERE s.event_id > 3",
                 "TRADE_DT = '20240115' AND event_id > 3", f"{_ON_DAY} AND event_id > 3"),
}


def _keyed_form(spark, sf_dir, form):
    """A kept text loaded by both dates; the keys that each load stored."""
    _views(spark, sf_dir)
    sql, _, changed = KEYED_FORMS[form]
    spec, = specs_from_keyed({"windevents": KEYED["windevents"] | {"sql": sql, "all_cols": {"event_id": KEYED["windevents"]["all_cols"]["event_id"]}}})
    out = []
    for profile in ("business", "change") if changed else ("business",):
        root = scratch_dir(spark, "form")
        load_table(spark, spec, W, root, profile)
        out.append(scan_load_date(spark, root, spec.original_table, W).select(F.lit(profile).alias("profile"), F.col("event_id").cast("long").alias("event_id")))
    return out[0].unionByName(out[1]) if changed else out[0]


for _form in KEYED_FORMS:
    QUERIES[f"keyed_form_{_form}"] = lambda spark, sf_dir, form=_form: _keyed_form(spark, sf_dir, form)


@query("daily_load_all")
def daily_load_all(spark, sf_dir):
    """The daily run: every important incremental table, by change date."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_all")
    specs = specs_of(select_tables_flagged(catalog_frame(spark, V.demo_catalog())))
    load_all(spark, specs, W, root, "change")
    return read_audit(spark, root).select("select_table", "table_empty", "row_count", "status")


LISTED = ["ordersfeed", "customersnap", "nationsnap"]


@query("select_tables_listed")
def q_select_tables_listed(spark, sf_dir):
    """The first loader's run: only the tables named in a list, business
    date, strict columns; snapshots included."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_listed")
    names = spark.createDataFrame([(n,) for n in LISTED], "table_name string")
    specs = specs_of(select_tables_listed(catalog_frame(spark, V.demo_catalog()), names))
    load_all(spark, specs, O, root, "v1")
    return read_audit(spark, root).select("select_table", "table_empty", "row_count", "status")


def _two_stores(spark, specs, day):
    left = scratch_dir(spark, "store_business")
    right = scratch_dir(spark, "store_change")
    load_all(spark, specs, day, left, "business")
    load_all(spark, specs, day, right, "change")
    return left, right


@query("daily_reconcile")
def daily_reconcile(spark, sf_dir):
    """The day's business-date load against its change-date load, by key."""
    _views(spark, sf_dir)
    left, right = _two_stores(spark, [V.WINDEVENTS], W)
    return reconcile_day(spark, V.WINDEVENTS, W, left, right).counts()


@query("daily_load_many")
def daily_load_many(spark, sf_dir):
    """Three tables with rows on the day, loaded by change date side by side."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "load_many")
    load_all(spark, V.order_catalog(), O, root, "change")
    return read_audit(spark, root).select("select_table", "table_empty", "row_count", "status")


@query("daily_reconcile_many")
def daily_reconcile_many(spark, sf_dir):
    """The business-date loads of three tables against their change-date loads."""
    _views(spark, sf_dir)
    left, right = _two_stores(spark, V.order_catalog(), O)
    return reconcile_all(spark, V.order_catalog(), O, left, right).drop("error")


@query("daily_reconcile_all")
def daily_reconcile_all(spark, sf_dir):
    _views(spark, sf_dir)
    left, right = _two_stores(spark, flagged(V.demo_catalog()), W)
    return reconcile_all(spark, V.demo_catalog(), W, left, right).drop("error")


# ---------------------------------------------------------------------------
# sources
# ---------------------------------------------------------------------------
@query("scan_sql_query")
def q_scan_sql_query(spark, sf_dir):
    _views(spark, sf_dir)
    return scan_sql_query(
        spark, "SELECT event_id, OPDATE, OPMODE, TRADE_DT FROM vendor_windevents "
               "WHERE TRADE_DT = :load_date", W)


@query("scan_chunked")
def q_scan_chunked(spark, sf_dir):
    """One change day fetched in chunks; the day's range reaches the row groups."""
    events = scan_chunks(spark, f"{sf_dir}/events.parquet", ["event_id", "event_type", "ts"])
    return FL.filter_change_day(events, "ts", W)


@query("scan_load_date")
def q_scan_load_date(spark, sf_dir):
    """Three loads into one store (the day, the next day, the day again);
    reading the day returns exactly one copy of it."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "scan_day")
    for day in (W, NEXT_W, W):
        load_table(spark, V.WINDEVENTS, day, root, "business")
    return scan_load_date(spark, root, V.WINDEVENTS.original_table, W)


@query("list_loaded_tables")
def q_list_loaded_tables(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "listing")
    load_all(spark, flagged(V.demo_catalog()), W, root, "change")
    return list_loaded_tables(read_audit(spark, root), W)


@query("comparable_tables")
def q_comparable_tables(spark, sf_dir):
    _views(spark, sf_dir)
    left, right = _two_stores(spark, flagged(V.demo_catalog()), W)
    return comparable_tables(read_audit(spark, left), read_audit(spark, right), W)


# ---------------------------------------------------------------------------
# sinks
# ---------------------------------------------------------------------------
@query("load_partition")
def q_load_partition(spark, sf_dir):
    """Rerun-safe day slice: load, load another day, reload; read the day."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "partition")
    for day in (O, "19970516", O):
        load_table(spark, V.ORDERSFEED, day, root, "change")
    return scan_load_date(spark, root, V.ORDERSFEED.original_table, O)


@query("load_snapshot")
def q_load_snapshot(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "snapshot")
    load_table(spark, V.CUSTOMERSNAP, W, root, "v1")
    load_table(spark, V.CUSTOMERSNAP, W, root, "v1")
    return scan_snapshot_table(spark, root, stored_name(V.CUSTOMERSNAP, "v1"))


# A bound that the smallest table exceeds.
BOUND = 2_500


@query("load_bounded_files")
def q_load_bounded_files(spark, sf_dir):
    """Whole lineitem written with at most BOUND rows per file."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "bounded")
    src = spark.table("vendor_lineitemfeed")
    out = project_declared(src, V.LINEITEMFEED.all_cols)
    write_snapshot(out, root, "LINEITEMFEED", max_records=BOUND)
    per_file = (scan_snapshot_table(spark, root, "LINEITEMFEED")
                .groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")))
    return per_file.agg(F.sum("n").cast("long").alias("total_rows"),
                        (F.max("n") <= BOUND).alias("within_bound"), (F.count(F.lit(1)) > 1).alias("several_files"))


@query("skip_empty_load")
def q_skip_empty_load(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "empty")
    audit = load_table(spark, V.WINDEVENTS, EMPTY_DAY, root, "change")
    return audit.select(*AUDIT_COLS)


@query("load_outcome")
def q_load_outcome(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "outcome")
    load_table(spark, V.WINDEVENTS, W, root, "change")
    return read_audit(spark, root).select(*AUDIT_COLS)


@query("load_sidecar_v1")
def q_load_sidecar_v1(spark, sf_dir):
    """The first loader's rows have no LOAD_DATE, and neither has their description."""
    _views(spark, sf_dir)
    root = scratch_dir(spark, "sidecar_v1")
    load_table(spark, V.ORDERSFEED, O, root, "v1")
    return read_sidecar(spark, root).select("table_name", "original_table", "date_column", "position", "column_name", "original_type", "parquet_type")


@query("load_sidecar")
def q_load_sidecar(spark, sf_dir):
    _views(spark, sf_dir)
    root = scratch_dir(spark, "sidecar")
    load_table(spark, V.WINDEVENTS, W, root, "change")
    return read_sidecar(spark, root).select(
        "table_name", "original_table", "dynamic", "date_column",
        F.array_join("primary_key", ",").alias("primary_key"), "position", "column_name",
        "original_type", "parquet_type")


def _orders_pair(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    return orders, V.changed_orders(orders)


@query("reconcile_report")
def q_reconcile_report(spark, sf_dir):
    left, right = _orders_pair(spark, sf_dir)
    rec = reconcile(left, right, ["o_orderkey"], left_name="df_load", right_name="df_opdate")
    log = scratch_dir(spark, "report")
    write_report(rec, log, "ORDERS", W)
    return read_report(spark, log, "counts")


# ---------------------------------------------------------------------------
# filters and set operations
# ---------------------------------------------------------------------------
@query("filter_business_date")
def q_filter_business_date(spark, sf_dir):
    return FL.filter_business_date(_view(spark, sf_dir, "windevents"), "TRADE_DT", W)


@query("scan_snapshot")
def q_scan_snapshot(spark, sf_dir):
    return FL.scan_snapshot(_view(spark, sf_dir, "nationsnap"))


@query("filter_change_day")
def q_filter_change_day(spark, sf_dir):
    return FL.filter_change_day(_view(spark, sf_dir, "windevents"), "OPDATE", W)


@query("filter_entry_time")
def q_filter_entry_time(spark, sf_dir):
    return FL.filter_entry_time(_view(spark, sf_dir, "ordersfeed"), "ENTRYTIME", O)


@query("filter_opmode_new")
def q_filter_opmode_new(spark, sf_dir):
    return FL.filter_opmode_new(_view(spark, sf_dir, "windevents"))


@query("filter_opmode_changed")
def q_filter_opmode_changed(spark, sf_dir):
    return FL.filter_opmode_changed(_view(spark, sf_dir, "windevents"), "TRADE_DT", W)


@query("incremental_filter")
def q_incremental_filter(spark, sf_dir):
    return FL.incremental_filter(_view(spark, sf_dir, "windevents"), V.WINDEVENTS, W, "change")


@query("change_load_union")
def q_change_load_union(spark, sf_dir):
    return FL.change_load_union(_view(spark, sf_dir, "windevents"), V.WINDEVENTS, W)


@query("load_date_of")
def q_load_date_of(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return ev.select("event_id", load_date_of(F.col("ts")).alias("load_date"))


# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------
@query("project_declared")
def q_project_declared(spark, sf_dir):
    return project_declared(_view(spark, sf_dir, "ordersfeed"), V.ORDERSFEED.all_cols, strict=True)


@query("project_tolerant")
def q_project_tolerant(spark, sf_dir):
    return project_tolerant(_view(spark, sf_dir, "windevents"), V.WINDEVENTS.all_cols,
                            change_column="OPDATE")


@query("add_load_date")
def q_add_load_date(spark, sf_dir):
    return add_load_date(_table(spark, sf_dir, "orders"), O)


# ---------------------------------------------------------------------------
# scalar rules
# ---------------------------------------------------------------------------
@query("fill_float")
def q_fill_float(spark, sf_dir):
    c = _view(spark, sf_dir, "customersnap")
    return c.select("c_custkey",
                    fill_float(F.col("c_acctbal"), _dtype(c, "c_acctbal")).alias("c_acctbal"),
                    fill_float(F.col("c_acctbal_txt"), _dtype(c, "c_acctbal_txt")).alias("c_acctbal_txt"))


@query("fill_int")
def q_fill_int(spark, sf_dir):
    e = _view(spark, sf_dir, "windevents")
    return e.select("event_id",
                    fill_int(F.col("user_id"), _dtype(e, "user_id")).alias("user_id"),
                    fill_int(F.col("value_num"), _dtype(e, "value_num")).alias("value_int"),
                    fill_int(F.col("UPDATE_TIME"), _dtype(e, "UPDATE_TIME")).alias("update_epoch"))


@query("fill_string")
def q_fill_string(spark, sf_dir):
    e = _view(spark, sf_dir, "windevents")
    return e.select("event_id", fill_string(F.col("value_txt")).alias("value_txt"))


@query("to_epoch_seconds")
def q_to_epoch_seconds(spark, sf_dir):
    ev = _table(spark, sf_dir, "events")
    return ev.select("event_id", to_epoch_seconds(F.col("ts"), _dtype(ev, "ts")).alias("epoch_s"))


@query("change_day_int")
def q_change_day_int(spark, sf_dir):
    e = _view(spark, sf_dir, "windevents")
    epoch = to_epoch_seconds(F.col("OPDATE"), _dtype(e, "OPDATE"))
    return e.select("event_id",
                    change_day_int(F.col("OPDATE"), _dtype(e, "OPDATE")).alias("opdate_day"),
                    change_day_int(F.col("UPDATE_TIME"), _dtype(e, "UPDATE_TIME")).alias("update_day"),
                    change_day_int(epoch, T.LongType()).alias("epoch_day"))


@query("day_text")
def q_day_text(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    return o.select("o_orderkey", day_text(F.col("o_orderdate"), _dtype(o, "o_orderdate")).alias("day"))


@query("cast_declared")
def q_cast_declared(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey",
                     cast_declared(F.col("l_linenumber"), T.LongType()).alias("l_linenumber"),
                     cast_declared(F.col("l_quantity"), T.LongType()).alias("l_quantity"),
                     cast_declared(F.col("l_tax"), T.StringType()).alias("l_tax"))


@query("check_write_schema")
def q_check_write_schema(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey",
        check_write_schema(F.col("l_orderkey"), T.LongType(), T.IntegerType(), "l_orderkey").alias("l_orderkey32"),
        check_write_schema(F.col("l_quantity"), T.DoubleType(), T.IntegerType(), "l_quantity").alias("l_quantity"))


@query("values_equal")
def q_values_equal(spark, sf_dir):
    left, right = _orders_pair(spark, sf_dir)
    l, r = left.alias("l"), right.alias("r")
    j = l.join(r, F.col("l.o_orderkey") == F.col("r.o_orderkey"), "inner")
    cols = [F.col("l.o_orderkey").alias("o_orderkey")]
    for c in ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"):
        cols.append(values_equal(F.col(f"l.{c}"), F.col(f"r.{c}"), _dtype(left, c), _dtype(right, c))
                    .alias(f"{c}_equal"))
    return j.select(*cols)


# ---------------------------------------------------------------------------
# reconciliation
# ---------------------------------------------------------------------------
def _orders_rec(spark, sf_dir):
    left, right = _orders_pair(spark, sf_dir)
    return reconcile(left, right, ["o_orderkey"], left_name="df_load", right_name="df_opdate")


def _lineitem_pair(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    right = (li.where(F.col("l_partkey") % 50 != 0)
             .withColumn("l_tax", F.when(F.col("l_suppkey") % 40 == 0, F.col("l_tax") + F.lit(0.01))
                         .otherwise(F.col("l_tax"))))
    return li, right


LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("reconcile_status")
def q_reconcile_status(spark, sf_dir):
    return _orders_rec(spark, sf_dir).status()


@query("reconcile_left_only")
def q_reconcile_left_only(spark, sf_dir):
    return _orders_rec(spark, sf_dir).left_only()


@query("reconcile_right_only")
def q_reconcile_right_only(spark, sf_dir):
    return _orders_rec(spark, sf_dir).right_only()


@query("reconcile_common")
def q_reconcile_common(spark, sf_dir):
    return _orders_rec(spark, sf_dir).common()


@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    return _orders_rec(spark, sf_dir).counts()


@query("reconcile_columns")
def q_reconcile_columns(spark, sf_dir):
    return _orders_rec(spark, sf_dir).columns()


@query("reconcile_max_diff")
def q_reconcile_max_diff(spark, sf_dir):
    return _orders_rec(spark, sf_dir).columns().select("column", "max_diff")


@query("reconcile_null_diff")
def q_reconcile_null_diff(spark, sf_dir):
    return _orders_rec(spark, sf_dir).columns().select("column", "null_diff")


@query("reconcile_shape")
def q_reconcile_shape(spark, sf_dir):
    return _orders_rec(spark, sf_dir).shape()


@query("reconcile_schema")
def q_reconcile_schema(spark, sf_dir):
    return _orders_rec(spark, sf_dir).schema()


@query("reconcile_sample_unequal")
def q_reconcile_sample_unequal(spark, sf_dir):
    return _orders_rec(spark, sf_dir).sample_unequal()


@query("reconcile_sample_one_sided")
def q_reconcile_sample_one_sided(spark, sf_dir):
    rec = _orders_rec(spark, sf_dir)
    return (rec.sample_one_sided("left").withColumn("side", F.lit("left"))
            .unionByName(rec.sample_one_sided("right").withColumn("side", F.lit("right")),
                         allowMissingColumns=True))


@query("duplicate_keys")
def q_duplicate_keys(spark, sf_dir):
    return duplicate_keys(_table(spark, sf_dir, "lineitem"), LINE_KEYS)


@query("reconcile_dup_keys")
def q_reconcile_dup_keys(spark, sf_dir):
    left, right = _lineitem_pair(spark, sf_dir)
    return reconcile(left, right, LINE_KEYS).status()


@query("reconcile_dup_counts")
def q_reconcile_dup_counts(spark, sf_dir):
    left, right = _lineitem_pair(spark, sf_dir)
    return reconcile(left, right, LINE_KEYS).counts()


@query("reconcile_hot_key")
def q_reconcile_hot_key(spark, sf_dir):
    """A key holding a third of all rows, nearly all exact copies."""
    li = _table(spark, sf_dir, "lineitem")
    return reconcile(V.hot_lineitem(li), V.hot_lineitem(li, changed=True), LINE_KEYS).counts()


# Rows of a key, and positions of a block, that make the split of hot keys run on the test tables.
SPLIT = {"hot_group_rows": 500, "block_rows": 900}


def _hot_rec(spark, sf_dir):
    """The hot key differs on both sides; the keys are split into bins and blocks."""
    li = _table(spark, sf_dir, "lineitem")
    return reconcile(V.hot_lineitem(li), V.hot_lineitem(li, changed=True), LINE_KEYS, **SPLIT)


@query("reconcile_hot_key_status")
def q_reconcile_hot_key_status(spark, sf_dir):
    return _hot_rec(spark, sf_dir).status().groupBy("l_linenumber", "_merge").agg(
        F.count(F.lit(1)).alias("n"), F.min("__ord").alias("first_ord"), F.max("__ord").alias("last_ord"),
        F.sum("__ord").alias("sum_ord"))


@query("reconcile_hot_key_columns")
def q_reconcile_hot_key_columns(spark, sf_dir):
    return _hot_rec(spark, sf_dir).columns().select("column", "match_cnt", "unequal_cnt", "max_diff", "null_diff")


@query("reconcile_hot_key_constant")
def q_reconcile_hot_key_constant(spark, sf_dir):
    """A hot key whose shared columns are constant: only one-sided columns tell its rows apart."""
    li = _table(spark, sf_dir, "lineitem")
    key = (F.col("l_orderkey") % 3 == 0).alias("k")
    left = li.select(key, F.lit(1).alias("v"), F.col("l_partkey").alias("own_l"))
    right = li.where(F.col("l_partkey") % 7 != 0).select(key, F.lit(1).alias("v"), F.col("l_suppkey").alias("own_r"))
    return reconcile(left, right, ["k"], **SPLIT).counts()


def _key_types(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    left = orders.select(F.col("o_orderkey").alias("k"), "o_custkey")
    right = orders.where("o_orderkey % 5 <> 0").select(
        (F.col("o_orderkey") + F.when(F.col("o_orderkey") % 7 == 0, 0.5).otherwise(0.0)).alias("k"), "o_custkey")
    return left, right


@query("reconcile_key_types")
def q_reconcile_key_types(spark, sf_dir):
    """A whole-number key against a fractional one: both become one type first."""
    left, right = _key_types(spark, sf_dir)
    return reconcile(left, right, ["k"]).counts()


@query("values_equal_edges")
def q_values_equal_edges(spark, sf_dir):
    """Whole numbers beyond 2^53, infinities, NaN and null made from event ids."""
    e = _table(spark, sf_dir, "events").select("event_id")
    i = F.col("event_id")
    big = F.lit(1 << 53) + i
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    l = e.select(i, big.alias("b"), F.when(i % 4 == 0, inf).when(i % 4 == 1, nan).when(i % 4 == 2, F.lit(None).cast("double")).otherwise(i.cast("double")).alias("d"))
    r = e.select(i, (big + i % 2).alias("b"), F.when(i % 8 < 4, inf).when(i % 3 == 0, nan).when(i % 3 == 1, F.lit(None).cast("double")).otherwise(-inf).alias("d"))
    return reconcile(l, r, ["event_id"]).columns()


def _written_values(spark, sf_dir):
    """Lineitem by a repeating key, with a shared column of two types: zeros of
    both signs, NaN, null and infinities, written differently on either side."""
    li = _table(spark, sf_dir, "lineitem")
    k, p = (F.col("l_orderkey") % 40).alias("k"), F.col("l_partkey")
    inf, nan, none = F.lit(float("inf")), F.lit(float("nan")), F.lit(None).cast("double")
    left = F.when(p % 6 == 0, F.lit(-0.0)).when(p % 6 == 1, nan).when(p % 6 == 2, inf).when(p % 6 == 3, none).otherwise((p % 5).cast("double"))
    right = F.when(p % 6 == 0, F.lit(0.0)).when(p % 6 == 1, none).when(p % 6 == 2, inf).when(p % 6 == 3, nan).otherwise((p % 5).cast("double"))
    return li.select(k, left.alias("v")), li.where("l_suppkey % 9 <> 0").select(k, right.cast("float").alias("v"))


@query("reconcile_written_values")
def q_reconcile_written_values(spark, sf_dir):
    """What counts as equal stands side by side, however it is written and however a key is paired."""
    left, right = _written_values(spark, sf_dir)
    by_rows, by_runs = (reconcile(left, right, ["k"], **more).counts() for more in ({}, SPLIT))
    return by_rows.withColumn("way", F.lit("rows")).unionByName(by_runs.withColumn("way", F.lit("runs")))


@query("reconcile_mostly_equal")
def q_reconcile_mostly_equal(spark, sf_dir):
    """Lineitem against itself with one order in two thousand changed: few key ranges differ, the rest is counted."""
    li = _table(spark, sf_dir, "lineitem")
    changed = li.withColumn("l_tax", F.when(F.col("l_orderkey") % 2000 == 7, F.col("l_tax") + F.lit(0.01)).otherwise(F.col("l_tax")))
    return reconcile(li, changed.where("l_orderkey % 2000 <> 9"), LINE_KEYS).counts()


def _wide_orders(spark, sf_dir):
    """Two loads with twelve columns before the key."""
    orders = _table(spark, sf_dir, "orders")
    right = V.changed_orders(orders).drop("o_flag")
    pad = [F.col("o_custkey").alias(f"c{i:02d}") for i in range(12)]
    return (orders.select(*pad, "o_orderkey", "o_totalprice"),
            right.select(*pad, "o_orderkey", "o_totalprice"))


def _report_section(spark, sf_dir, section, wide=False):
    left, right = _wide_orders(spark, sf_dir) if wide else _orders_pair(spark, sf_dir)
    rec = reconcile(left, right, ["o_orderkey"], left_name="df_load", right_name="df_opdate")
    log = scratch_dir(spark, "report")
    write_report(rec, log, "ORDERS", W)
    return read_report(spark, log, section)


@query("reconcile_report_columns")
def q_reconcile_report_columns(spark, sf_dir):
    return _report_section(spark, sf_dir, "columns")


@query("reconcile_report_samples")
def q_reconcile_report_samples(spark, sf_dir):
    return _report_section(spark, sf_dir, "sample_unequal").drop("left_value", "right_value")


@query("reconcile_report_one_sided")
def q_reconcile_report_one_sided(spark, sf_dir):
    return _report_section(spark, sf_dir, "sample_one_sided", wide=True).select("side", "rank", "key")


def _epoch_events(spark, sf_dir):
    """The change log with its change time as whole epoch seconds."""
    e = _table(spark, sf_dir, "events")
    return e.select("event_id", to_epoch_seconds(F.col("ts"), _dtype(e, "ts")).alias("CHANGED"))


@query("filter_change_day_epoch")
def q_filter_change_day_epoch(spark, sf_dir):
    return FL.filter_change_day(_epoch_events(spark, sf_dir), "CHANGED", W)


@query("filter_entry_time_epoch")
def q_filter_entry_time_epoch(spark, sf_dir):
    """Orders carry whole days, so their epoch is the day's first second."""
    o = _table(spark, sf_dir, "orders")
    epoch = to_epoch_seconds(F.col("o_orderdate"), _dtype(o, "o_orderdate"))
    return FL.filter_entry_time(o.select("o_orderkey", epoch.alias("CHANGED")), "CHANGED", O)
