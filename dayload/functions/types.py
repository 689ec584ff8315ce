"""Declared type names to Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

# The type names a catalog may declare.  ``logical_type`` uses
# the frame-library names, ``parquet_type`` the Arrow names.
LOGICAL_TYPES = {
    "float64": T.DoubleType(), "float32": T.FloatType(), "float": T.DoubleType(),
    "int64": T.LongType(), "int32": T.IntegerType(), "int16": T.ShortType(),
    "int8": T.ByteType(), "int": T.LongType(),
    "str": T.StringType(), "object": T.StringType(), "string": T.StringType(),
    "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "datetime64[ns]": T.TimestampNTZType(), "datetime64": T.TimestampNTZType(),
}

PARQUET_TYPES = {
    "double": T.DoubleType(), "float64": T.DoubleType(),
    "float": T.FloatType(), "float32": T.FloatType(),
    "int64": T.LongType(), "int32": T.IntegerType(), "int16": T.ShortType(), "int8": T.ByteType(),
    "string": T.StringType(), "utf8": T.StringType(), "large_string": T.StringType(),
    "bool": T.BooleanType(),
    "timestamp[ns]": T.TimestampNTZType(), "timestamp[us]": T.TimestampNTZType(),
    "timestamp[ms]": T.TimestampNTZType(), "timestamp[s]": T.TimestampNTZType(),
    "date32": T.DateType(), "date32[day]": T.DateType(), "binary": T.BinaryType(),
}

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def _lookup(name: str, table: dict) -> T.DataType:
    key = (name or "").strip().lower()
    if key in table:
        return table[key]
    return T._parse_datatype_string(key)  # any Spark DDL type name


def logical_type(name: str) -> T.DataType:
    return _lookup(name, LOGICAL_TYPES)


def parquet_type(name: str) -> T.DataType:
    return _lookup(name, PARQUET_TYPES)


def is_integral(t: T.DataType) -> bool:
    return isinstance(t, INTEGRAL)


def is_fractional(t: T.DataType) -> bool:
    return isinstance(t, FRACTIONAL)


def is_numeric(t: T.DataType) -> bool:
    return isinstance(t, T.NumericType)


def is_timestamp(t: T.DataType) -> bool:
    return isinstance(t, TIMESTAMPS)


def integral_width(t: T.DataType) -> int:
    return {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}[type(t)]
