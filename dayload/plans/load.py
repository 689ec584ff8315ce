"""Daily loads as Spark jobs (PIP-1..4).

``load_plan`` is the whole lazy plan of one table and day:
scan -> pushed-down row filter -> one normalising projection, without a
shuffle; ``load_table`` writes it with one job, in which one shuffle regroups a
thin slice into files of a fair size, and records the outcome.  ``load_all`` runs many tables as concurrent jobs from a small
driver thread pool and keeps a failure as an audit row."""

from __future__ import annotations

import traceback
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from ..catalog import LOAD_DATE_MARKER, MODE_COLUMN, TableSpec
from ..operators.filters import BY_BUSINESS, change_test_text, incremental_filter
from ..operators.project import CHANGE, PROFILES, LoadProfile, normalize
from ..session import own_pool
from ..sinks.writers import (AUDIT_SCHEMA, append_audit, audit_row, write_sidecar,
                             write_slice, write_snapshot)
from ..sources.query import CHUNK_ROWS, source_frame
from ..vendor_sql import VendorSql

# Tables defined concurrently by one run of all tables.
LOAD_THREADS = 5


def _profile(profile: LoadProfile | str) -> LoadProfile:
    return PROFILES[profile] if isinstance(profile, str) else profile


def sidecar_date_column(spec: TableSpec, profile: LoadProfile) -> str | None:
    """The date column a load actually filtered on."""
    if not spec.dynamic:
        return spec.date_column
    return spec.date_column if profile.by == BY_BUSINESS else spec.change_column


def load_plan(spark: SparkSession, spec: TableSpec, load_date: str,
              profile: LoadProfile | str = CHANGE, source: DataFrame | None = None,
              connections: dict | None = None) -> DataFrame:
    """The stored rows of one table and day, not yet written."""
    profile = _profile(profile)
    if source is not None:
        return normalize(incremental_filter(source, spec, load_date, profile.by), spec, load_date, profile)
    if spec.sql_error:
        raise ValueError(f"{spec.table_name}: {spec.sql_error}")
    if not spec.dynamic or LOAD_DATE_MARKER not in spec.source_sql:
        rows = incremental_filter(source_frame(spark, spec, load_date, connections), spec, load_date, profile.by)
    elif profile.by == BY_BUSINESS:  # the text tests its business date itself
        rows = source_frame(spark, spec, load_date, connections)
    else:
        rows = _changed_rows(spark, spec, load_date, profile.by, connections)
    return normalize(rows, spec, load_date, profile)


def _changed_rows(spark: SparkSession, spec: TableSpec, load_date: str, by: str, connections: dict | None) -> DataFrame:
    """The rows of a change date from a text that tests the business date.

    The text's test gives way to the change predicate.  Where the query returns
    plain rows with the columns needed, the predicate is a filter on top of
    it, typed and pushed down; else it is written in the test's place."""
    sql = VendorSql.read(spec.source_sql)
    if sql.plain and all(t.conjunct for t in sql.on_column(spec.date_column)):
        free = replace(spec, source_sql=sql.swapped(spec.date_column, lambda t: "1 = 1"))
        src = source_frame(spark, free, load_date, connections)
        needed = [spec.change_column, *([MODE_COLUMN, spec.date_column] if spec.is_wind else [])]
        if {c.lower() for c in needed} <= {c.lower() for c in src.columns}:
            return incremental_filter(src, spec, load_date, by)
    native = spec.data_base in (connections or {})
    inside = sql.swapped(spec.date_column, lambda t: change_test_text(t, spec, load_date, by, native))
    return source_frame(spark, replace(spec, source_sql=inside), load_date, connections)


def stored_name(spec: TableSpec, profile: LoadProfile | str) -> str:
    """The table's folder: its catalog name in the first loader's layout, else the vendor's name."""
    return spec.original_table if _profile(profile).with_load_date else spec.table_name


def load_table(spark: SparkSession, spec: TableSpec, load_date: str, root: str,
               profile: LoadProfile | str = CHANGE, source: DataFrame | None = None,
               max_records: int = CHUNK_ROWS, write_audit: bool = True,
               connections: dict | None = None) -> DataFrame:
    """Load one table for one day into ``root``; returns its audit row.
    ``connections`` maps a vendor family to its ``JdbcSource``."""
    profile = _profile(profile)
    date_col = sidecar_date_column(spec, profile)
    try:
        out = load_plan(spark, spec, load_date, profile, source, connections)
        if spec.dynamic:
            result = write_slice(out, root, stored_name(spec, profile), load_date, max_records)
        else:
            result = write_snapshot(out, root, stored_name(spec, profile), max_records)
        if not result.empty:  # data first, then its description
            write_sidecar(spark, root, spec, date_col, profile.with_load_date)
        audit = audit_row(spark, load_date=load_date, spec=spec, root=root, result=result,
                          date_column=date_col, profile=profile.name)
    except Exception as exc:  # kept as an audit row, the run goes on
        msg = f"{type(exc).__name__}: {exc}"
        audit = audit_row(spark, load_date=load_date, spec=spec, root=root, result=None,
                          date_column=date_col, profile=profile.name, error=msg or traceback.format_exc(limit=1))
    if write_audit:
        append_audit(audit, root)
    return audit


def load_all(spark: SparkSession, specs: list[TableSpec], load_date: str, root: str,
             profile: LoadProfile | str = CHANGE, threads: int = LOAD_THREADS,
             max_records: int = CHUNK_ROWS, connections: dict | None = None) -> DataFrame:
    """Load every given table for the day as concurrent Spark jobs, each
    table's in a scheduler pool of its own; one audit row per table, failures
    included (PIP-4)."""
    profile = _profile(profile)
    if not specs:
        return spark.createDataFrame([], AUDIT_SCHEMA)

    def one(spec: TableSpec) -> DataFrame:
        with own_pool(spark, f"load-{spec.table_name}"):
            return load_table(spark, spec, load_date, root, profile, max_records=max_records,
                              write_audit=False, connections=connections)

    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        audits = list(pool.map(one, specs))
    out = audits[0]
    for a in audits[1:]:
        out = out.unionByName(a)
    out = out.coalesce(1)
    append_audit(out, root)
    return out


def flagged(specs: list[TableSpec]) -> list[TableSpec]:
    """Important incremental tables, as the daily runs select them (FLT-9)."""
    return [s for s in specs if s.is_important and s.dynamic]


def listed(specs: list[TableSpec], names: list[str]) -> list[TableSpec]:
    """Only the named tables (FLT-10)."""
    wanted = set(names)
    return [s for s in specs if s.table_name in wanted]
