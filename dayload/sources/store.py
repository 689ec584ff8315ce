"""Reading the store back: one day of one table, and listings (SRC-3, 6, 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import LOAD_DATE


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


# Snapshot tables live in one constant partition so they can be replaced
# atomically by dynamic partition overwrite.
SNAPSHOT = "SNAPSHOT"
CURRENT = "current"


def snapshot_path(root: str, table: str) -> str:
    return f"{table_path(root, table)}/{SNAPSHOT}={CURRENT}"


def slice_path(root: str, table: str, load_date: str) -> str:
    return f"{table_path(root, table)}/{LOAD_DATE}={int(load_date)}"


def scan_load_date(spark: SparkSession, root: str, table: str, load_date: str,
                   keep_load_date: bool = True) -> DataFrame:
    """One stored day.  Only that partition's folder is listed and read, so the
    cost does not grow with the number of stored days; ``LOAD_DATE`` comes
    back as bigint."""
    df = (spark.read.option("basePath", table_path(root, table))
          .parquet(slice_path(root, table, load_date)))
    if keep_load_date:
        cols = [c for c in df.columns if c != LOAD_DATE]
        return df.select(*cols, F.col(LOAD_DATE).cast(T.LongType()).alias(LOAD_DATE))
    return df.drop(LOAD_DATE)


def scan_snapshot_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current snapshot of a table (its folder only, no partition column)."""
    return spark.read.parquet(snapshot_path(root, table))


def list_loaded_tables(audit: DataFrame, load_date: str | None = None) -> DataFrame:
    """Tables holding a non-empty slice, from the audit rows (SRC-6)."""
    ok = audit.where((F.col("status") == "loaded") & ~F.col("table_empty"))
    if load_date is not None:
        ok = ok.where(F.col("load_date") == load_date)
    return ok.select("select_table").distinct()


def comparable_tables(audit_left: DataFrame, audit_right: DataFrame, load_date: str) -> DataFrame:
    """Tables whose day is present in both stores (SRC-7)."""
    left = list_loaded_tables(audit_left, load_date)
    right = list_loaded_tables(audit_right, load_date)
    return left.join(right, "select_table", "inner")
