"""Writing the store: day slices, snapshots, schema sidecar, audit rows
(SNK-1..6).

Slices are written with dynamic partition overwrite on ``LOAD_DATE``: a rerun
replaces only that day, atomically at job commit, and a retried task never
leaves partial files behind.  Row counts come from an ``Observation`` on the
written frame, so no second scan is needed."""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import LOAD_DATE, TableSpec
from ..sources.query import CHUNK_ROWS
from ..sources.store import CURRENT, SNAPSHOT, slice_path, snapshot_path, table_path

SIDECAR = "_sidecar"
AUDIT = "_audit"
RUN = "run_id"

AUDIT_SCHEMA = T.StructType([
    T.StructField("load_date", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("select_table", T.StringType()),
    T.StructField("table_path", T.StringType()),
    T.StructField("table_empty", T.BooleanType()),
    T.StructField("dynamic", T.BooleanType()),
    T.StructField("date_column", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("file_count", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("profile", T.StringType()),
    T.StructField("loaded_at", T.StringType()),
])

SIDECAR_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("original_table", T.StringType()),
    T.StructField("dynamic", T.BooleanType()),
    T.StructField("date_column", T.StringType()),
    T.StructField("primary_key", T.ArrayType(T.StringType())),
    T.StructField("last_update", T.StringType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("original_type", T.StringType()),
    T.StructField("parquet_type", T.StringType()),
])

# Fixed value: source type recorded for the added LOAD_DATE column.
LOAD_DATE_SOURCE_TYPE = "derived"


@dataclass
class WriteResult:
    path: str
    rows: int
    files: int

    @property
    def empty(self) -> bool:
        return self.rows == 0


def _count_files(spark: SparkSession, path: str) -> int:
    # File listing of one slice only; no data is read.
    return len(spark.read.parquet(path).inputFiles())


def write_slice(df: DataFrame, root: str, table: str, load_date: str,
                max_records: int = CHUNK_ROWS, rebalance: bool = True) -> WriteResult:
    """Write (or rewrite) one day of one table (SNK-1, SNK-3, SNK-4).

    A day is a thin filter over a large scan, so every scan task would write
    its own tiny file; ``rebalance`` lets AQE regroup the (small) filtered
    rows into files near the advisory partition size first.  An empty frame
    writes no partition, so an earlier slice of the day stays, as a load that
    fetched nothing never touched the old file."""
    spark = df.sparkSession
    if LOAD_DATE not in df.columns:
        df = df.withColumn(LOAD_DATE, F.lit(int(load_date)).cast(T.LongType()))
    if rebalance:
        df = df.hint("rebalance")
    obs = Observation(f"slice_{table}_{load_date}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records)
     .partitionBy(LOAD_DATE)
     .parquet(table_path(root, table)))
    rows = int(obs.get["rows"])
    path = slice_path(root, table, load_date)
    return WriteResult(path if rows else "", rows, _count_files(spark, path) if rows else 0)


def write_snapshot(df: DataFrame, root: str, table: str,
                   max_records: int = CHUNK_ROWS) -> WriteResult:
    """Replace a whole snapshot table (SNK-2).

    The rows go to one constant partition written with dynamic partition
    overwrite, so the old snapshot is swapped out only when the job commits
    (a failed job leaves it intact, where a plain overwrite deletes it
    first), and an empty source writes nothing and leaves it alone (SNK-4)."""
    spark = df.sparkSession
    obs = Observation(f"snapshot_{table}")
    observed = df.withColumn(SNAPSHOT, F.lit(CURRENT)).observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records)
     .partitionBy(SNAPSHOT)
     .parquet(table_path(root, table)))
    rows = int(obs.get["rows"])
    path = snapshot_path(root, table)
    return WriteResult(path if rows else "", rows, _count_files(spark, path) if rows else 0)


def sidecar_frame(spark: SparkSession, spec: TableSpec, date_column: str | None,
                  with_load_date: bool = True) -> DataFrame:
    """One row per declared column describing the stored table (SNK-5)."""
    now = _dt.datetime.now().isoformat(sep=" ")
    keys = spec.keys()
    cols = [(c.name, c.database_type, c.parquet_type) for c in spec.all_cols]
    if with_load_date:
        cols.append((LOAD_DATE, LOAD_DATE_SOURCE_TYPE, "int64"))
    rows = [(spec.table_name, spec.original_table, spec.dynamic, date_column, keys, now,
             i, name, dbt, pqt) for i, (name, dbt, pqt) in enumerate(cols)]
    return spark.createDataFrame(rows, SIDECAR_SCHEMA)


def write_sidecar(spark: SparkSession, root: str, spec: TableSpec, date_column: str | None,
                  with_load_date: bool = True) -> str:
    """Replace the table's sidecar rows; other tables' rows stay."""
    path = f"{root.rstrip('/')}/{SIDECAR}"
    (sidecar_frame(spark, spec, date_column, with_load_date)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name").parquet(path))
    return path


def read_sidecar(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(SIDECAR_SCHEMA).parquet(f"{root.rstrip('/')}/{SIDECAR}")


def audit_row(spark: SparkSession, *, load_date: str, spec: TableSpec, root: str,
              result: WriteResult | None, date_column: str | None, profile: str,
              error: str | None = None) -> DataFrame:
    """The outcome of one table load (SNK-6); paths are relative to the root."""
    rel = ""
    if result is not None and result.path:
        rel = result.path[len(root.rstrip('/')) + 1:] if result.path.startswith(root.rstrip('/')) else result.path
    row = (load_date, spec.table_name, spec.original_table, rel,
           True if result is None else result.empty, spec.dynamic, date_column,
           0 if result is None else result.rows, 0 if result is None else result.files,
           "failed" if error else "loaded", error, profile,
           _dt.datetime.now().isoformat(sep=" "))
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def append_audit(audit: DataFrame, root: str) -> None:
    """Add a run's rows.  Each run writes a partition of its own, staged by
    itself, so runs into one root at the same time don't touch each other."""
    (audit.withColumn(RUN, F.lit(uuid.uuid4().hex)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("load_date", RUN)
     .parquet(f"{root.rstrip('/')}/{AUDIT}"))


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    """The store's audit rows; a store never loaded has none."""
    try:
        return spark.read.schema(AUDIT_SCHEMA).parquet(f"{root.rstrip('/')}/{AUDIT}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], AUDIT_SCHEMA)
