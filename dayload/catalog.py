"""Table catalog: what to load, how to type it, and which columns are the key.

The catalog is configuration (tens of tables), so specs live on the driver as
small dataclasses; the same content is also available as a DataFrame for the
catalog operators (selection, key lookup, column listing).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vendor_sql import MARKER, UnreadableSql, filled

# Vendor family whose change column is OPDATE with day matching and mode
# branches; every other family uses ENTRYTIME with an exact match.
WIND = "wind"
WIND_CHANGE_COLUMN = "OPDATE"
OTHER_CHANGE_COLUMN = "ENTRYTIME"
MODE_COLUMN = "OPMODE"
LOAD_DATE = "LOAD_DATE"

COLUMN_STRUCT = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("database_type", T.StringType()),
    T.StructField("logical_type", T.StringType()),
    T.StructField("parquet_type", T.StringType()),
])

CATALOG_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("data_base", T.StringType()),
    T.StructField("original_table", T.StringType()),
    T.StructField("source_sql", T.StringType()),
    T.StructField("dynamic", T.BooleanType()),
    T.StructField("is_important", T.BooleanType()),
    T.StructField("date_column", T.StringType()),
    T.StructField("primary_key", T.ArrayType(T.StringType())),
    T.StructField("all_cols", T.ArrayType(COLUMN_STRUCT)),
])


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    database_type: str
    logical_type: str
    parquet_type: str


@dataclass(frozen=True)
class TableSpec:
    table_name: str
    data_base: str
    original_table: str
    source_sql: str
    dynamic: bool
    is_important: bool
    date_column: str | None
    primary_key: tuple[str, ...] | None
    all_cols: tuple[ColumnSpec, ...] = field(default_factory=tuple)
    sql_error: str | None = None  # why the source SQL can't be used; loads of the table fail with it

    @property
    def is_wind(self) -> bool:
        return self.data_base == WIND

    @property
    def change_column(self) -> str:
        return WIND_CHANGE_COLUMN if self.is_wind else OTHER_CHANGE_COLUMN

    def keys(self) -> list[str]:
        """Key columns: the catalog's, else the registry's; blanks dropped."""
        return primary_key_for(self.table_name, self.primary_key)

    def to_row(self) -> tuple:
        return (self.table_name, self.data_base, self.original_table, self.source_sql,
                self.dynamic, self.is_important, self.date_column,
                list(self.primary_key) if self.primary_key is not None else None,
                [(c.name, c.database_type, c.logical_type, c.parquet_type) for c in self.all_cols])

    @staticmethod
    def from_row(row) -> "TableSpec":
        return TableSpec(
            table_name=row["table_name"], data_base=row["data_base"],
            original_table=row["original_table"] or row["table_name"],
            source_sql=row["source_sql"], dynamic=bool(row["dynamic"]),
            is_important=bool(row["is_important"]), date_column=row["date_column"],
            primary_key=tuple(row["primary_key"]) if row["primary_key"] is not None else None,
            all_cols=tuple(ColumnSpec(c["name"], c["database_type"], c["logical_type"],
                                      c["parquet_type"]) for c in (row["all_cols"] or [])))


# ---------------------------------------------------------------------------
# Registered key columns per vendor table.  Lookup is by the
# upper-cased table name; blank entries are dropped at lookup time, and a
# table registered with an empty list has no key.
# ---------------------------------------------------------------------------
KEY_REGISTRY: dict[str, list[str]] = {
    'aindexcsi500weight': ['S_INFO_WINDCODE', 'S_CON_WINDCODE', 'TRADE_DT'],
    'aindexeodprices': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'aindexfreeweight': ['S_INFO_WINDCODE', 'S_CON_WINDCODE', 'TRADE_DT'],
    'aindexhs300closeweight': ['S_INFO_WINDCODE', 'S_CON_WINDCODE', 'TRADE_DT'],
    'aindexhs300freeweight': ['S_INFO_WINDCODE', 'S_CON_WINDCODE', 'TRADE_DT'],
    'aindexmembers': ['S_INFO_WINDCODE', 'S_CON_WINDCODE'],
    'aindexmemberscitics': ['S_INFO_WINDCODE', 'S_CON_WINDCODE'],
    'ASHAREPLANTRADE': ['S_INFO_WINDCODE', 'ANN_DT', 'ANN_DT_NEW'],
    'ashareannfinancialindicator': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD'],
    'ashareauditopinion': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD'],
    'asharebalancesheet': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD', 'STATEMENT_TYPE'],
    'ashareblocktrade': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'asharecalendar': ['S_INFO_EXCHMARKET'],
    'asharecashflow': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD', 'STATEMENT_TYPE'],
    'ashareconsensusdata': ['S_INFO_WINDCODE', 'EST_DT', 'EST_REPORT_DT', 'CONSEN_DATA_CYCLE_TYP'],
    'ashareconsensusrollingdata': ['S_INFO_WINDCODE', 'EST_DT', 'ROLLING_TYPE'],
    'ashareconseption': ['S_INFO_WINDCODE', 'WIND_SEC_CODE'],
    'asharedescription': ['S_INFO_WINDCODE'],
    'asharedividend': ['S_INFO_WINDCODE', 'S_DIV_PROGRESS', 'ANN_DT'],
    'ashareearningest': ['S_INFO_WINDCODE', 'WIND_CODE'],
    'ashareeodderivativeindicator': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'ashareeodprices': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'asharefinancialderivative': ['S_INFO_COMPCODE', 'BEGINDATE', 'ENDDATE'],
    'asharefinancialindicator': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD'],
    'ashareincome': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD', 'STATEMENT_TYPE'],
    'ashareipo': ['S_INFO_WINDCODE'],
    'ashareisactivity': ['S_INFO_WINDCODE', 'S_SURVEYDATE', 'S_SURVEYTIME', 'S_ACTIVITIESTYPE'],
    'asharemajorevent': ['S_INFO_WINDCODE', 'S_EVENT_CATEGORYCODE', 'S_EVENT_ANNCEDATE'],
    'asharemanagementholdreward': ['S_INFO_WINDCODE', 'ANN_DATE'],
    'asharemoneyflow': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'ashareprofitexpress': ['S_INFO_WINDCODE', 'ANN_DT', 'REPORT_PERIOD'],
    'ashareprofitnotice': ['S_INFO_WINDCODE', 'S_PROFITNOTICE_DATE', 'S_PROFITNOTICE_PERIOD'],
    'asharereginv': ['S_INFO_WINDCODE', 'STR_DATE'],
    'asharesalessegment': ['S_INFO_WINDCODE', 'REPORT_PERIOD', 'S_SEGMENT_ITEM'],
    'asharest': ['S_INFO_WINDCODE', 'ANN_DT'],
    'asharetradingsuspension': ['S_INFO_WINDCODE', 'S_DQ_SUSPENDDATE'],
    'ccommodityfutureseodprices': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'ccommodityfuturespositions': ['S_INFO_WINDCODE', 'TRADE_DT', 'S_INFO_COMPCODE', 'FS_INFO_TYPE'],
    'cfuturescalendar': [],
    'cfuturescontpro': ['S_INFO_WINDCODE'],
    'cfuturescontprochange': ['S_INFO_WINDCODE'],
    'cfuturesdescription': ['S_INFO_WINDCODE'],
    'cfuturesmarginratio': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'chinamutualfundstockportfolio': ['S_INFO_WINDCODE', 'ANN_DATE'],
    'con_forecast_roll_stk': ['stock_code', 'con_date'],
    'con_forecast_stk': ['stock_code', 'con_date'],
    'con_rating_stk': ['stock_code', 'con_date'],
    'con_target_price_stk': ['stock_code', 'con_date'],
    'der_conf_stk': ['stock_code', 'con_date', 'con_year'],
    'der_con_dev_roll_stk': ['stock_code', 'con_date'],
    'der_diver_stk': ['stock_code', 'con_date', 'con_year'],
    'der_excess_stock': ['stock_code', 'declare_date', 'report_year'],
    'der_focus_stk': ['stock_code', 'con_date'],
    'der_forecast_adjust_num': ['stock_code', 'con_date', 'con_year'],
    'der_prob_below_stock': ['stock_code', 'report_year', 'declare_date'],
    'der_prob_excess_stock': ['stock_code', 'report_year', 'report_quarter', 'declare_date'],
    'der_rating_adjust_num': ['stock_code', 'con_date'],
    'der_report_num': ['stock_code', 'con_date'],
    'rpt_earnings_adjust': ['stock_code', 'current_create_date', 'report_year'],
    'rpt_forecast_stk': ['stock_code', 'create_date', 'report_year'],
    'rpt_gogoal_rating': ['gg_rating_code'],
    'rpt_rating_adjust': ['stock_code', ''],
    'rpt_target_price_adjust': ['stock_code', 'updatetime', 'organ_id'],
    'shscchannelholdings': ['S_INFO_WINDCODE', 'TRADE_DT'],
    'shscmembers': ['S_INFO_WINDCODE'],
    'szscmembers': ['S_INFO_WINDCODE'],
}


class UnknownTableError(KeyError):
    pass


def primary_key_for(table_name: str, declared: tuple[str, ...] | list[str] | None = None) -> list[str]:
    """Key columns of one table: the catalog's when given, else the registry's."""
    if declared is not None:
        return [k for k in declared if k and k.strip()]
    registry = {k.upper(): v for k, v in KEY_REGISTRY.items()}
    if table_name.upper() not in registry:
        raise UnknownTableError(table_name)
    return [k for k in registry[table_name.upper()] if k and k.strip()]


def registry_frame(spark: SparkSession) -> DataFrame:
    """The key registry as (table_key, registered_key) with upper-cased names."""
    rows = [(k.upper(), v) for k, v in KEY_REGISTRY.items()]
    return spark.createDataFrame(rows, "table_key string, registered_key array<string>")


def catalog_frame(spark: SparkSession, specs: list[TableSpec]) -> DataFrame:
    return spark.createDataFrame([s.to_row() for s in specs], CATALOG_SCHEMA)


def specs_of(catalog: DataFrame) -> list[TableSpec]:
    """Catalog rows to specs (the catalog is tens of rows of configuration)."""
    return [TableSpec.from_row(r) for r in catalog.collect()]


def _blankless(c: Column) -> Column:
    return F.filter(c, lambda k: F.trim(k) != F.lit(""))


def primary_key_of(catalog: DataFrame, registry: DataFrame) -> DataFrame:
    """Key columns per catalog table: the catalog's own, else the registry's
    (by upper-cased name).  A table known to neither raises at run time."""
    joined = catalog.join(registry, F.upper(catalog["table_name"]) == registry["table_key"], "left")
    key = F.coalesce(catalog["primary_key"], registry["registered_key"])
    return joined.select(
        catalog["table_name"],
        F.when(key.isNull(), F.raise_error(F.concat(F.lit("no key registered for table "),
                                                     catalog["table_name"])))
         .otherwise(_blankless(key)).alias("primary_key"))


def resolve_table_name(catalog: DataFrame) -> DataFrame:
    """Catalog name to the vendor's original table name (PRJ-4)."""
    return catalog.select("table_name",
                          F.coalesce("original_table", "table_name").alias("original_table"))


def select_tables_flagged(catalog: DataFrame) -> DataFrame:
    """Tables marked important and incremental (FLT-9)."""
    return catalog.where(F.col("is_important") & F.col("dynamic"))


def select_tables_listed(catalog: DataFrame, names: DataFrame) -> DataFrame:
    """Only catalog tables named in ``names.table_name`` (FLT-10)."""
    return catalog.join(names.select("table_name").distinct(), "table_name", "left_semi")


def catalog_columns(catalog: DataFrame) -> DataFrame:
    """One row per declared column, in declared order (SRC-5)."""
    return (catalog.select("table_name", F.posexplode("all_cols").alias("position", "c"))
            .select("table_name", "position", "c.name", "c.database_type",
                    "c.logical_type", "c.parquet_type"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog JSON (an array of table records, or one record per line)."""
    return spark.read.schema(CATALOG_SCHEMA).json(path, multiLine=True)


# ---------------------------------------------------------------------------
# Keyed catalogs: {table: {sql, dynamic, data_base, original_table,
# date_column, is_important, primary_key, all_cols: {column: {...}}}} as
# the daily loaders keep them, plus the first loader's field names.
# ---------------------------------------------------------------------------
LOAD_DATE_MARKER = MARKER


def _read_text(spark: SparkSession, path: str) -> str:
    # A configuration file of a few kilobytes, read through Spark so any
    # Hadoop-visible path works.
    return spark.read.text(path, wholetext=True).collect()[0][0]


def specs_from_keyed(obj: dict) -> list[TableSpec]:
    """Table specs from a keyed catalog.  In the SQL of an incremental table a
    ``%s`` date placeholder becomes the ``:load_date`` parameter marker (bound,
    never formatted) and ``%%`` a single ``%``; a text that can't be read
    fails the loads of its own table only.  Column order is the order of
    ``all_cols``."""
    specs = []
    for name, t in obj.items():
        cols = t.get("all_cols", t.get("all_columns")) or {}
        sql, error = t.get("sql", ""), None
        if t.get("dynamic", False):
            try:
                sql = filled(sql)
            except UnreadableSql as exc:
                error = str(exc)
        specs.append(TableSpec(
            table_name=name, data_base=t.get("data_base", ""),
            original_table=t.get("original_table", t.get("oraignal_table")) or name,
            source_sql=sql, dynamic=bool(t.get("dynamic", False)),
            is_important=bool(t.get("is_important", True)),
            date_column=t.get("date_column", t.get("date_where")),
            primary_key=tuple(t["primary_key"]) if t.get("primary_key") is not None else None,
            all_cols=columns_from_keyed(cols), sql_error=error))
    return specs


def read_keyed_catalog(spark: SparkSession, path: str) -> list[TableSpec]:
    import json
    return specs_from_keyed(json.loads(_read_text(spark, path)))


def read_table_list(spark: SparkSession, path: str, field: str = "need_tables") -> list[str]:
    """Names from a ``{"need_tables": [...]}`` file (the list-driven run)."""
    import json
    return list(json.loads(_read_text(spark, path))[field])


def columns_from_keyed(cols: dict) -> tuple[ColumnSpec, ...]:
    """``{column: {database_type, pandas_type, parquet_type}}`` in file order."""
    return tuple(ColumnSpec(c, d.get("database_type", ""), d.get("pandas_type", d.get("logical_type", "")),
                            d.get("parquet_type", "")) for c, d in cols.items())


def read_column_types(spark: SparkSession, path: str) -> tuple[ColumnSpec, ...]:
    """A per-table column-type file, as the first loader keeps them (SRC-5)."""
    import json
    return columns_from_keyed(json.loads(_read_text(spark, path)))
