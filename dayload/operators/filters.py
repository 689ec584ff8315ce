"""Date and mode predicates for incremental loads (FLT-1..7, SET-1).

Predicates are plain column comparisons so Catalyst pushes them into the
Parquet or JDBC scan.  The change-day test is a half-open range on the raw
column, never a formatted string, so the scan can skip row groups."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import LOAD_DATE_MARKER, MODE_COLUMN, TableSpec
from ..functions.timefmt import day_bounds, epoch_bounds
from ..functions.types import is_integral, is_numeric
from ..vendor_sql import DateTest

# Row modes of the vendor's change log.
MODE_NEW = "0"
MODE_CHANGED = "1"

BY_BUSINESS = "business"
BY_CHANGE = "change"            # change_day for the wind family, entry_time otherwise
BY_CHANGE_DAY = "change_day"
BY_ENTRY_TIME = "entry_time"


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def date_literal(dtype: T.DataType, load_date: str) -> Column:
    """The ``yyyyMMdd`` load date as a literal of the column's type."""
    day, _ = day_bounds(load_date)
    if isinstance(dtype, T.StringType):
        return F.lit(load_date)
    if is_integral(dtype) or is_numeric(dtype):
        return F.lit(int(load_date)).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(_dt.date.fromisoformat(day))
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.lit(day + " 00:00:00").cast(dtype)
    raise TypeError(f"no date literal for {dtype}")


def business_date_predicate(df: DataFrame, date_column: str, load_date: str) -> Column:
    return F.col(date_column) == date_literal(_dtype(df, date_column), load_date)


def filter_business_date(df: DataFrame, date_column: str, load_date: str) -> DataFrame:
    """Rows of the business date (FLT-1)."""
    return df.where(business_date_predicate(df, date_column, load_date))


def scan_snapshot(df: DataFrame) -> DataFrame:
    """Snapshot tables are read whole (FLT-2)."""
    return df


def change_day_predicate(df: DataFrame, column: str, load_date: str) -> Column:
    """Change time falls on the load day: ``day <= c < day + 1`` (FLT-3)."""
    dtype = _dtype(df, column)
    c = F.col(column)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        start, end = day_bounds(load_date)
        return (c >= F.lit(start + " 00:00:00").cast(dtype)) & (c < F.lit(end + " 00:00:00").cast(dtype))
    if is_integral(dtype):  # epoch seconds, as change_day_int reads them
        start, end = epoch_bounds(load_date)
        return (c >= F.lit(start).cast(dtype)) & (c < F.lit(end).cast(dtype))
    return c == date_literal(dtype, load_date)


def filter_change_day(df: DataFrame, column: str, load_date: str) -> DataFrame:
    return df.where(change_day_predicate(df, column, load_date))


def entry_time_predicate(df: DataFrame, column: str, load_date: str) -> Column:
    """Change time equals the load date exactly; no day truncation (FLT-4).
    A whole number is epoch seconds."""
    if is_integral(_dtype(df, column)):
        return F.col(column) == F.lit(epoch_bounds(load_date)[0]).cast(_dtype(df, column))
    return F.col(column) == date_literal(_dtype(df, column), load_date)


def filter_entry_time(df: DataFrame, column: str, load_date: str) -> DataFrame:
    return df.where(entry_time_predicate(df, column, load_date))


def opmode_new_predicate() -> Column:
    return F.col(MODE_COLUMN) == F.lit(MODE_NEW)


def opmode_changed_predicate(df: DataFrame, date_column: str, load_date: str) -> Column:
    """Changed rows whose business date is not in the past (FLT-6)."""
    return (F.col(MODE_COLUMN) == F.lit(MODE_CHANGED)) & \
        (F.col(date_column) >= date_literal(_dtype(df, date_column), load_date))


def filter_opmode_new(df: DataFrame) -> DataFrame:
    return df.where(opmode_new_predicate())


def filter_opmode_changed(df: DataFrame, date_column: str, load_date: str) -> DataFrame:
    return df.where(opmode_changed_predicate(df, date_column, load_date))


def mode_predicate(df: DataFrame, date_column: str, load_date: str) -> Column:
    """Either mode branch.  The branches are disjoint, so one scan with OR
    returns exactly the rows of their UNION ALL.  Other or missing modes drop."""
    return opmode_new_predicate() | opmode_changed_predicate(df, date_column, load_date)


def resolve_by(spec: TableSpec, by: str) -> str:
    if by == BY_CHANGE:
        return BY_CHANGE_DAY if spec.is_wind else BY_ENTRY_TIME
    if by not in (BY_BUSINESS, BY_CHANGE_DAY, BY_ENTRY_TIME):
        raise ValueError(f"unknown load mode {by!r}")
    return by


def incremental_predicate(df: DataFrame, spec: TableSpec, load_date: str, by: str) -> Column | None:
    """The whole row filter of one incremental load (FLT-7)."""
    if not spec.dynamic:
        return None
    mode = resolve_by(spec, by)
    if mode == BY_BUSINESS:
        return business_date_predicate(df, spec.date_column, load_date)
    if mode == BY_ENTRY_TIME:
        return entry_time_predicate(df, spec.change_column, load_date)
    pred = change_day_predicate(df, spec.change_column, load_date)
    if spec.is_wind:
        pred = pred & mode_predicate(df, spec.date_column, load_date)
    return pred


def incremental_filter(df: DataFrame, spec: TableSpec, load_date: str, by: str = BY_CHANGE) -> DataFrame:
    pred = incremental_predicate(df, spec, load_date, by)
    return df if pred is None else df.where(pred)


def change_test_text(test: DateTest, spec: TableSpec, load_date: str, by: str, native: bool) -> str:
    """The change predicate as text, for the place of a query's own date test
    (``native``: in the vendor's dialect, else the session's)."""
    mode = resolve_by(spec, by)
    day, _ = day_bounds(load_date)
    changed = test.on(spec.change_column)
    if mode == BY_ENTRY_TIME:
        return f"{changed} = '{int(load_date)}'" if native else f"CAST({changed} AS TIMESTAMP_NTZ) = TIMESTAMP_NTZ'{day} 00:00:00'"
    on_day = f"convert(varchar(100), {changed}, 112) = '{int(load_date)}'" if native else f"CAST({changed} AS DATE) = DATE'{day}'"
    if not spec.is_wind:
        return on_day
    kind, date = test.on(MODE_COLUMN), test.on(spec.date_column)
    return f"({on_day} AND ({kind} = '{MODE_NEW}' OR ({kind} = '{MODE_CHANGED}' AND {date} >= {LOAD_DATE_MARKER})))"


def change_load_union(df: DataFrame, spec: TableSpec, load_date: str) -> DataFrame:
    """The change-day load written as UNION ALL of the two mode branches
    (SET-1).  Same rows as ``incremental_filter(by='change')``; kept for
    callers that want the branches separately."""
    day = filter_change_day(df, spec.change_column, load_date)
    return filter_opmode_new(day).unionByName(filter_opmode_changed(day, spec.date_column, load_date))
