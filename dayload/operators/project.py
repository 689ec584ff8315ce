"""Normalise a source frame to the declared schema (PRJ-1..3, PRJ-6, SCA-*).

One ``select`` does everything: missing-value fills, timestamp conversions,
declared casts, the storage-type check and the load-date column, so the
whole step stays inside one whole-stage-codegen projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import LOAD_DATE, ColumnSpec, TableSpec
from ..functions.cast import cast_declared, check_write_schema
from ..functions.fill import fill_float, fill_int, fill_string
from ..functions.timefmt import change_day_int
from ..functions.types import is_fractional, is_integral, logical_type, parquet_type


@dataclass(frozen=True)
class LoadProfile:
    """How one loader variant shapes its output."""
    name: str
    by: str               # row filter, see operators.filters
    strict: bool          # every declared column must exist in the source
    change_day: bool      # change column becomes a yyyyMMdd integer
    with_load_date: bool  # LOAD_DATE is a data column


V1 = LoadProfile("v1", "business", strict=True, change_day=False, with_load_date=False)
BUSINESS = LoadProfile("business", "business", strict=False, change_day=True, with_load_date=True)
CHANGE = LoadProfile("change", "change", strict=False, change_day=True, with_load_date=True)
PROFILES = {p.name: p for p in (V1, BUSINESS, CHANGE)}


class MissingColumnsError(ValueError):
    pass


def declared_present(df: DataFrame, columns: tuple[ColumnSpec, ...] | list[ColumnSpec],
                     strict: bool) -> list[ColumnSpec]:
    """Declared columns in declared order; absent ones are skipped (PRJ-2) or,
    when ``strict``, reported as an error."""
    have = set(df.columns)
    missing = [c.name for c in columns if c.name not in have]
    if strict and missing:
        raise MissingColumnsError(f"declared columns missing from source: {missing}")
    return [c for c in columns if c.name in have]


def normalized_column(df: DataFrame, spec: ColumnSpec, change_column: str | None) -> Column:
    """Fill, convert and cast one declared column; the result carries the
    declared types as field metadata."""
    src = df.schema[spec.name].dataType
    c = F.col(spec.name)
    logical = logical_type(spec.logical_type)
    if spec.name == change_column:
        value = change_day_int(c, src)
        if isinstance(logical, (T.StringType,)) or is_integral(logical):
            value = value.cast(logical)
        else:
            logical = T.LongType()
    elif is_fractional(logical):
        value = fill_float(c, src).cast(logical)
    elif is_integral(logical):
        value = fill_int(c, src).cast(logical)
    elif isinstance(logical, T.StringType):
        value = fill_string(c, src)
    else:
        value = cast_declared(c, logical)
    stored = check_write_schema(value, logical, parquet_type(spec.parquet_type), spec.name)
    return stored.alias(spec.name, metadata={"database_type": spec.database_type,
                                             "logical_type": spec.logical_type,
                                             "parquet_type": spec.parquet_type})


def project_declared(df: DataFrame, columns, strict: bool = True,
                     change_column: str | None = None) -> DataFrame:
    """Declared columns only, declared order and types (PRJ-1)."""
    keep = declared_present(df, columns, strict)
    return df.select([normalized_column(df, c, change_column) for c in keep])


def project_tolerant(df: DataFrame, columns, change_column: str | None = None) -> DataFrame:
    """As ``project_declared``, skipping declared columns the source lacks (PRJ-2)."""
    return project_declared(df, columns, strict=False, change_column=change_column)


def load_date_column(load_date: str) -> Column:
    return F.lit(int(load_date)).cast(T.LongType()).alias(
        LOAD_DATE, metadata={"database_type": "derived", "logical_type": "int64",
                             "parquet_type": "int64"})


def add_load_date(df: DataFrame, load_date: str) -> DataFrame:
    """Constant ``LOAD_DATE`` bigint as the last column (PRJ-3)."""
    return df.select(*[F.col(c) for c in df.columns if c != LOAD_DATE], load_date_column(load_date))


def normalize(df: DataFrame, spec: TableSpec, load_date: str, profile: LoadProfile) -> DataFrame:
    """Source rows to stored rows for one table and day, as one projection.

    Day slices always carry ``LOAD_DATE`` (it is the partition column of the
    store); a snapshot carries it only when the profile adds it."""
    keep = declared_present(df, spec.all_cols, profile.strict)
    change = spec.change_column if profile.change_day else None
    cols = [normalized_column(df, c, change) for c in keep]
    if spec.dynamic or profile.with_load_date:
        cols.append(load_date_column(load_date))
    return df.select(*cols)
