"""Value equality used by the comparison (SCA-10).

Numbers are equal within ``abs_tol + rel_tol * |right|``; NaN counts as
missing, so NaN, NaN and null are all equal to each other.  Whole numbers and
decimals are compared as they are; both sides become doubles only where one of
them is fractional.  Other types are compared exactly, null-safe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import is_fractional, is_integral, is_numeric


def nan_to_null(c: Column, dtype: T.DataType) -> Column:
    if is_fractional(dtype):
        return F.when(F.isnan(c), F.lit(None)).otherwise(c)
    return c


def comparable_pair(l: Column, r: Column, lt: T.DataType, rt: T.DataType) -> tuple[Column, Column, bool]:
    """Bring both sides to one type; returns (left, right, numeric)."""
    if is_numeric(lt) and is_numeric(rt):
        if not is_fractional(lt) and not is_fractional(rt):
            return l, r, True
        return (nan_to_null(l, lt).cast(T.DoubleType()), nan_to_null(r, rt).cast(T.DoubleType()), True)
    if lt == rt:
        return l, r, False
    return l.cast(T.StringType()), r.cast(T.StringType()), False


def values_equal(l: Column, r: Column, lt: T.DataType, rt: T.DataType,
                 abs_tol: float = 0.0, rel_tol: float = 0.0) -> Column:
    """Never null: true when both sides count as the same value."""
    a, b, numeric = comparable_pair(l, r, lt, rt)
    same = a.eqNullSafe(b)
    if numeric and (abs_tol or rel_tol):
        close = _distance(a, b, lt, rt) <= F.lit(abs_tol) + F.lit(rel_tol) * F.abs(b.cast(T.DoubleType()))
        same = same | F.coalesce(close, F.lit(False))
    return same


def null_mismatch(l: Column, r: Column, lt: T.DataType, rt: T.DataType) -> Column:
    """Missing on exactly one side (NaN counts as missing)."""
    return nan_to_null(l, lt).isNull() != nan_to_null(r, rt).isNull()


def _distance(a: Column, b: Column, lt: T.DataType, rt: T.DataType) -> Column:
    """|a - b| as a double; whole numbers are subtracted before they lose digits."""
    if is_integral(lt) and is_integral(rt):
        wide = T.DecimalType(20, 0)
        return F.abs(a.cast(wide) - b.cast(wide)).cast(T.DoubleType())
    return F.abs(a.cast(T.DoubleType()) - b.cast(T.DoubleType()))


def abs_difference(l: Column, r: Column, lt: T.DataType, rt: T.DataType) -> Column | None:
    """|left - right| for numeric pairs, else None; 0 where the values are
    equal (infinities too), null where one is missing."""
    if not (is_numeric(lt) and is_numeric(rt)):
        return None
    a, b, _ = comparable_pair(l, r, lt, rt)
    return F.when(a == b, F.lit(0.0)).otherwise(_distance(a, b, lt, rt))
