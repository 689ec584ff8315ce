"""Declared casts and the write-schema check (SCA-7, SCA-8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .types import integral_width, is_fractional, is_integral


def cast_declared(c: Column, target: T.DataType) -> Column:
    """ANSI cast: bad text raises, never silently null (SCA-7)."""
    return c.cast(target)


def narrows(source: T.DataType, target: T.DataType) -> bool:
    """Whether a cast from ``source`` to ``target`` can lose values the way a
    safe Arrow conversion refuses: narrower integers, fractions to integers,
    integers too wide for a floating type, or doubles to floats."""
    if is_integral(target) and is_fractional(source):
        return True
    if is_integral(target) and is_integral(source):
        return integral_width(target) < integral_width(source)
    if is_integral(source) and is_fractional(target):
        return integral_width(source) > (4 if isinstance(target, T.DoubleType) else 2)
    return isinstance(source, T.DoubleType) and isinstance(target, T.FloatType)


def check_write_schema(c: Column, source: T.DataType, target: T.DataType, name: str) -> Column:
    """Cast to the storage type, raising when the value does not survive the
    round trip (SCA-8).  Same or widening types are a plain cast."""
    if source == target:
        return c
    out = c.cast(target)
    if not narrows(source, target):
        return out
    back = out.cast(T.DecimalType(38, 0)).cast(source) if is_integral(source) and is_fractional(target) else out.cast(source)
    survives = back.eqNullSafe(c)
    return F.when(survives, out).otherwise(
        F.raise_error(F.concat(F.lit(f"lossy cast of column {name} to {target.simpleString()}: "),
                               c.cast(T.StringType()))).cast(target))
