"""Vendor-shaped source tables derived from the driver's test tables.

Each view reshapes one given table into what a vendor database returns
(change time, row mode, business date, missing values), so every load reads
the whole given table.  Missing values are injected by key modulo rules,
identically in the oracle SQL.  ``demo_catalog`` declares these tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ColumnSpec, TableSpec

# Load dates used by the registered queries.
WIND_LOAD_DATE = "20240115"
OTHER_LOAD_DATE = "19970515"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null() -> F.Column:
    return F.lit(None)


def windevents(events: DataFrame) -> DataFrame:
    """``events`` as a wind-family change log."""
    k = F.col("event_id")
    mode = (F.when(F.col("event_type").isin("signup", "click"), F.lit("0"))
            .when(F.col("event_type").isin("view", "purchase"), F.lit("1"))
            .otherwise(F.lit("2")))
    trade_dt = F.date_format(F.date_add(F.to_date("ts"), (k % 5 - 2).cast("int")), "yyyyMMdd")
    return events.select(
        k.alias("event_id"),
        F.col("ts").alias("OPDATE"),
        mode.alias("OPMODE"),
        trade_dt.alias("TRADE_DT"),
        F.when(k % 9 == 0, _null()).otherwise(F.col("user_id")).alias("user_id"),
        F.when(k % 7 == 0, _null()).when(k % 7 == 1, F.lit(float("nan")))
         .otherwise(F.col("value")).alias("value_num"),
        F.when(k % 6 == 0, _null()).when(k % 6 == 1, F.lit("None")).when(k % 6 == 2, F.lit("none"))
         .otherwise(F.col("event_type")).alias("value_txt"),
        F.when(k % 10 == 3, _null()).otherwise(F.col("ts")).alias("UPDATE_TIME"),
        F.col("props").alias("extra"),
    )


def ordersfeed(orders: DataFrame) -> DataFrame:
    """``orders`` as another vendor's table: exact ENTRYTIME, text business date."""
    k = F.col("o_orderkey")
    con_date = F.date_format(F.date_add(F.to_date("o_orderdate"), (k % 3 - 1).cast("int")), "yyyyMMdd")
    return orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.col("o_orderdate").alias("ENTRYTIME"), con_date.alias("con_date"), "o_orderpriority")


def customersnap(customer: DataFrame) -> DataFrame:
    """``customer`` with text and number gaps, read as a snapshot."""
    k = F.col("c_custkey") % 7
    return customer.select(
        "c_custkey",
        F.when(k == 0, _null()).when(k == 1, F.lit("None")).otherwise(F.col("c_name")).alias("c_name"),
        F.when(k == 5, F.lit("None")).when(k == 6, _null())
         .otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey_txt"),
        F.when(k == 2, _null()).when(k == 3, F.lit(float("nan")))
         .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k == 4, F.lit("None")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal_txt"),
        "c_mktsegment")


def lineitemfeed(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as an incremental table keyed by a repeating key."""
    return lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").alias("ENTRYTIME"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("ship_dt"))


def windorders(orders: DataFrame) -> DataFrame:
    """``orders`` as a wind-family change log."""
    k = F.col("o_orderkey")
    return orders.select(
        "o_orderkey", F.col("o_orderdate").alias("OPDATE"), (k % 3).cast("string").alias("OPMODE"),
        F.date_format(F.date_add(F.to_date("o_orderdate"), (k % 5 - 2).cast("int")), "yyyyMMdd").alias("TRADE_DT"),
        "o_custkey", "o_totalprice")


def windlines(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as a wind-family change log with a key of two columns."""
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("OPDATE"), (k % 3).cast("string").alias("OPMODE"),
        F.date_format(F.date_add(F.to_date("l_shipdate"), (k % 5 - 2).cast("int")), "yyyyMMdd").alias("TRADE_DT"),
        "l_quantity", "l_returnflag")


def changed_orders(orders: DataFrame) -> DataFrame:
    """A second load of ``orders`` with known differences: every 97th key
    dropped, 0.5 added to every 89th price, every 83rd priority missing,
    copies with new keys for every 101st, and one extra column."""
    k = F.col("o_orderkey")
    kept = orders.where(k % 97 != 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(k % 89 == 0, F.col("o_totalprice") + F.lit(0.5)).otherwise(F.col("o_totalprice"))
         .alias("o_totalprice"),
        "o_orderdate",
        F.when(k % 83 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
         .alias("o_orderpriority"),
        F.col("o_orderstatus").alias("o_flag"))
    added = orders.where(k % 101 == 0).select(
        (k + F.lit(1_000_000_000)).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        "o_totalprice", "o_orderdate", "o_orderpriority", F.col("o_orderstatus").alias("o_flag"))
    return kept.unionByName(added)


def hot_lineitem(lineitem: DataFrame, changed: bool = False) -> DataFrame:
    """``lineitem`` with one hot key: every third order collapses onto key
    (0, 1) with only a few distinct row contents, so that key holds a third
    of all rows, nearly all of them exact copies.  ``changed`` drops every
    7th part and raises the tax of every 11th supplier first."""
    df = lineitem
    if changed:
        df = (df.where(F.col("l_partkey") % 7 != 0)
              .withColumn("l_tax", F.when(F.col("l_suppkey") % 11 == 0, F.col("l_tax") + F.lit(0.01))
                          .otherwise(F.col("l_tax"))))
    hot = F.col("l_orderkey") % 3 == 0

    def pick(hot_value, col: str):
        return F.when(hot, hot_value).otherwise(F.col(col)).alias(col)

    return df.select(
        pick(F.lit(0).cast("long"), "l_orderkey"),
        pick(F.col("l_partkey") % 4, "l_partkey"),
        pick(F.lit(0).cast("long"), "l_suppkey"),
        pick(F.lit(1), "l_linenumber"),
        pick(F.lit(1.0), "l_quantity"),
        pick(F.lit(1.0), "l_extendedprice"),
        pick(F.lit(0.0), "l_discount"),
        pick(F.lit(0.0), "l_tax"),
        "l_returnflag", "l_linestatus",
        pick(F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"), "l_shipdate"))


VIEW_BUILDERS = {
    "vendor_windevents": ("events", windevents),
    "vendor_ordersfeed": ("orders", ordersfeed),
    "vendor_customersnap": ("customer", customersnap),
    "vendor_lineitemfeed": ("lineitem", lineitemfeed),
    "vendor_windorders": ("orders", windorders),
    "vendor_windlines": ("lineitem", windlines),
    "vendor_nationsnap": ("nation", lambda df: df),
    "vendor_regionsnap": ("region", lambda df: df),
}


REGISTERED_CONF = "dayload.vendor_views.dir"


def register_vendor_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every vendor view over the given tables in ``sf_dir`` (once
    per session and folder)."""
    if (spark.conf.get(REGISTERED_CONF, None) == sf_dir
            and all(spark.catalog.tableExists(v) for v in VIEW_BUILDERS)):
        return
    for view, (table, build) in VIEW_BUILDERS.items():
        build(read_table(spark, sf_dir, table)).createOrReplaceTempView(view)
    spark.conf.set(REGISTERED_CONF, sf_dir)


def _cols(*rows: tuple[str, str, str, str]) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(*r) for r in rows)


WINDEVENTS = TableSpec(
    table_name="windevents", data_base="wind", original_table="WINDEVENTS",
    source_sql="SELECT * FROM vendor_windevents", dynamic=True, is_important=True,
    date_column="TRADE_DT", primary_key=("event_id",),
    all_cols=_cols(
        ("event_id", "bigint", "int64", "int64"),
        ("OPDATE", "datetime", "int64", "int64"),
        ("OPMODE", "varchar(1)", "str", "string"),
        ("TRADE_DT", "varchar(8)", "str", "string"),
        ("user_id", "int", "int64", "int64"),
        ("value_num", "float", "float64", "double"),
        ("value_txt", "varchar(40)", "str", "string"),
        ("UPDATE_TIME", "datetime", "int64", "int64"),
        ("MISSING_COL", "float", "float64", "double"),
    ))

ORDERSFEED = TableSpec(
    table_name="ordersfeed", data_base="vendorb", original_table="ORDERSFEED",
    source_sql="SELECT * FROM vendor_ordersfeed", dynamic=True, is_important=True,
    date_column="con_date", primary_key=("o_orderkey",),
    all_cols=_cols(
        ("o_orderkey", "bigint", "int64", "int64"),
        ("o_custkey", "bigint", "int64", "int64"),
        ("o_orderstatus", "char(1)", "str", "string"),
        ("o_totalprice", "decimal(15,2)", "float64", "double"),
        ("ENTRYTIME", "datetime", "int64", "int64"),
        ("con_date", "varchar(8)", "str", "string"),
        ("o_orderpriority", "varchar(15)", "str", "string"),
    ))

CUSTOMERSNAP = TableSpec(
    table_name="customersnap", data_base="vendorb", original_table="CUSTOMERSNAP",
    source_sql="SELECT * FROM vendor_customersnap", dynamic=False, is_important=True,
    date_column=None, primary_key=("c_custkey",),
    all_cols=_cols(
        ("c_custkey", "bigint", "int64", "int64"),
        ("c_name", "varchar(25)", "str", "string"),
        ("c_nationkey_txt", "varchar(4)", "int64", "int32"),
        ("c_acctbal", "decimal(15,2)", "float64", "double"),
        ("c_acctbal_txt", "varchar(20)", "float64", "double"),
        ("c_mktsegment", "varchar(10)", "str", "string"),
    ))

LINEITEMFEED = TableSpec(
    table_name="lineitemfeed", data_base="vendorb", original_table="LINEITEMFEED",
    source_sql="SELECT * FROM vendor_lineitemfeed", dynamic=True, is_important=False,
    date_column="ship_dt", primary_key=("l_orderkey", ""),
    all_cols=_cols(
        ("l_orderkey", "bigint", "int64", "int64"),
        ("l_linenumber", "int", "int64", "int32"),
        ("l_quantity", "float", "float64", "double"),
        ("l_extendedprice", "float", "float64", "double"),
        ("l_returnflag", "char(1)", "str", "string"),
        ("ENTRYTIME", "datetime", "int64", "int64"),
        ("ship_dt", "varchar(8)", "str", "string"),
    ))

WINDORDERS = TableSpec(
    table_name="windorders", data_base="wind", original_table="WINDORDERS",
    source_sql="SELECT * FROM vendor_windorders", dynamic=True, is_important=True,
    date_column="TRADE_DT", primary_key=("o_orderkey",),
    all_cols=_cols(
        ("o_orderkey", "bigint", "int64", "int64"),
        ("OPDATE", "datetime", "int64", "int64"),
        ("OPMODE", "varchar(1)", "str", "string"),
        ("TRADE_DT", "varchar(8)", "str", "string"),
        ("o_custkey", "bigint", "int64", "int64"),
        ("o_totalprice", "decimal(15,2)", "float64", "double"),
    ))

WINDLINES = TableSpec(
    table_name="windlines", data_base="wind", original_table="WINDLINES",
    source_sql="SELECT * FROM vendor_windlines", dynamic=True, is_important=True,
    date_column="TRADE_DT", primary_key=("l_orderkey", "l_linenumber"),
    all_cols=_cols(
        ("l_orderkey", "bigint", "int64", "int64"),
        ("l_linenumber", "int", "int64", "int64"),
        ("OPDATE", "datetime", "int64", "int64"),
        ("OPMODE", "varchar(1)", "str", "string"),
        ("TRADE_DT", "varchar(8)", "str", "string"),
        ("l_quantity", "float", "float64", "double"),
        ("l_returnflag", "char(1)", "str", "string"),
    ))

NATIONSNAP = TableSpec(
    table_name="nationsnap", data_base="wind", original_table="NATIONSNAP",
    source_sql="SELECT * FROM vendor_nationsnap", dynamic=False, is_important=False,
    date_column=None, primary_key=("n_nationkey",),
    all_cols=_cols(
        ("n_nationkey", "int", "int64", "int64"),
        ("n_name", "varchar(25)", "str", "string"),
        ("n_regionkey", "int", "int64", "int64"),
    ))

REGIONSNAP = TableSpec(
    table_name="regionsnap", data_base="wind", original_table="REGIONSNAP",
    source_sql="SELECT * FROM vendor_regionsnap", dynamic=False, is_important=False,
    date_column=None, primary_key=(),
    all_cols=_cols(
        ("r_regionkey", "int", "int64", "int64"),
        ("r_name", "varchar(25)", "str", "string"),
    ))


def order_catalog() -> list[TableSpec]:
    """Three incremental tables with rows on the same days."""
    return [ORDERSFEED, WINDORDERS, WINDLINES]


def demo_catalog() -> list[TableSpec]:
    return [WINDEVENTS, ORDERSFEED, CUSTOMERSNAP, LINEITEMFEED, NATIONSNAP, REGIONSNAP]
