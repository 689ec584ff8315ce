"""Time conversions: epoch seconds, yyyyMMdd day integers and text (SCA-4..6,
SCA-9, FLT-8).  Naive timestamps are taken as UTC without consulting the
session zone, so results do not depend on where the job runs."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import is_integral, is_timestamp

DAY_FORMAT = "yyyyMMdd"
# A missing change time is filled with 0 seconds first, i.e. 1970-01-01.
EPOCH_DAY = 19700101
MICROS = 1_000_000


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def trunc_div(c: Column, d: int) -> Column:
    """Integral division that cuts toward zero, exact for any long."""
    return ((c - c % F.lit(d)) / F.lit(d)).cast(T.LongType())


def epoch_micros(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)
    if isinstance(dtype, T.DateType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c.cast(T.TimestampNTZType()))
    raise TypeError(f"not a time type: {dtype}")


def as_naive(c: Column, dtype: T.DataType) -> Column:
    """Time-like input as TIMESTAMP_NTZ holding the UTC wall time."""
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, T.DateType):
        return c.cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch_ntz())
    if is_integral(dtype):  # epoch seconds
        return F.timestamp_add("SECOND", c.cast(T.LongType()), _epoch_ntz())
    raise TypeError(f"cannot read {dtype} as a time")


def to_epoch_seconds(c: Column, dtype: T.DataType) -> Column:
    """Whole epoch seconds, the fraction cut toward zero (SCA-4)."""
    return trunc_div(epoch_micros(c, dtype), MICROS)


def day_text(c: Column, dtype: T.DataType) -> Column:
    """Time as ``yyyyMMdd`` text (SCA-6)."""
    return F.date_format(as_naive(c, dtype), DAY_FORMAT)


def change_day_int(c: Column, dtype: T.DataType) -> Column:
    """Change time as a ``yyyyMMdd`` integer; a missing value counts as 0
    seconds, so it becomes 19700101 (SCA-5).  Integers are epoch seconds."""
    if not (is_timestamp(dtype) or isinstance(dtype, T.DateType) or is_integral(dtype)):
        raise TypeError(f"change column must be a time or epoch seconds, got {dtype}")
    day = day_text(c, dtype).cast(T.LongType())
    return F.coalesce(day, F.lit(EPOCH_DAY).cast(T.LongType()))


def load_date_of(anchor: Column | None = None, days_back: int = 1) -> Column:
    """``yyyyMMdd`` of the day ``days_back`` before ``anchor`` (default: today),
    the loaders' relative load date (FLT-8, SCA-9)."""
    base = F.current_date() if anchor is None else F.to_date(anchor)
    return F.date_format(F.date_sub(base, days_back), DAY_FORMAT)


def yesterday(today: _dt.date | None = None) -> str:
    """Driver-side default load date: yesterday as ``yyyyMMdd``."""
    return ((today or _dt.date.today()) - _dt.timedelta(days=1)).strftime("%Y%m%d")


def day_bounds(load_date: str) -> tuple[str, str]:
    """Half-open ``[day, next day)`` bounds as ISO text for a ``yyyyMMdd`` date."""
    d = _dt.datetime.strptime(load_date, "%Y%m%d").date()
    return d.isoformat(), (d + _dt.timedelta(days=1)).isoformat()


def epoch_bounds(load_date: str) -> tuple[int, int]:
    """The first second of the ``yyyyMMdd`` day and of the next one, as UTC epoch seconds."""
    start, end = (_dt.datetime.fromisoformat(d).replace(tzinfo=_dt.timezone.utc) for d in day_bounds(load_date))
    return int(start.timestamp()), int(end.timestamp())
