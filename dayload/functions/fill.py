"""Missing-value rules applied before the declared cast (SCA-1..3).

Numbers: null, NaN and the text ``'None'`` become 0; infinity is kept; junk
text raises (ANSI cast).  Text: null and exactly ``'None'`` become ``''``.
Other declared types keep their nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timefmt import to_epoch_seconds
from .types import is_fractional, is_numeric, is_timestamp

NONE_TEXT = "None"


def _strip_none(c: Column) -> Column:
    return F.nullif(c, F.lit(NONE_TEXT))


def fill_float(c: Column, dtype: T.DataType) -> Column:
    """To double: null / NaN / 'None' become 0.0 (SCA-1)."""
    if is_fractional(dtype):
        value = F.nanvl(c.cast(T.DoubleType()), F.lit(0.0))
    elif is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        value = c.cast(T.DoubleType())
    elif isinstance(dtype, T.StringType):
        value = _strip_none(c).cast(T.DoubleType())
    else:
        raise TypeError(f"cannot fill {dtype} as a float")
    return F.coalesce(value, F.lit(0.0))


def fill_int(c: Column, dtype: T.DataType) -> Column:
    """To long: null / NaN / 'None' become 0, fractions are cut toward zero,
    timestamps become epoch seconds (SCA-2, SCA-4)."""
    if is_fractional(dtype):
        value = F.nanvl(c.cast(T.DoubleType()), F.lit(0.0)).cast(T.LongType())
    elif is_numeric(dtype) or isinstance(dtype, T.BooleanType):
        value = c.cast(T.LongType())
    elif isinstance(dtype, T.StringType):
        value = _strip_none(c).cast(T.LongType())
    elif is_timestamp(dtype) or isinstance(dtype, T.DateType):
        value = to_epoch_seconds(c, dtype)
    else:
        raise TypeError(f"cannot fill {dtype} as an integer")
    return F.coalesce(value, F.lit(0).cast(T.LongType()))


def fill_string(c: Column, dtype: T.DataType | None = None) -> Column:
    """To text: null and exactly 'None' become '' (SCA-3)."""
    text = c if dtype is None or isinstance(dtype, T.StringType) else c.cast(T.StringType())
    return F.when(text.isNull() | (text == F.lit(NONE_TEXT)), F.lit("")).otherwise(text)
