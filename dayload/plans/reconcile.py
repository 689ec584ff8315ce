"""Reconciling two stores day by day (PIP-5, PIP-6, SNK-7).

For one table and day both stored slices are read (partition-pruned), paired
by the catalog key and compared; the report is a set of small datasets
partitioned by table and day, so reports of many days and tables can be
queried together.  Sample rows carry their key and values as JSON text so
every table shares one report schema."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import TableSpec
from ..operators.reconcile import NoKeyError, Reconciliation, reconcile
from ..session import own_pool
from ..sinks.writers import read_audit
from ..sources.store import comparable_tables, scan_load_date, scan_snapshot_table

# Report datasets written per table and day.
SECTIONS = ("counts", "columns", "shape", "schema", "sample_unequal", "sample_one_sided")

REPORT_KEYS = [T.StructField("table_name", T.StringType()), T.StructField("load_date", T.StringType())]

SUMMARY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_date", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_left", T.LongType()),
    T.StructField("rows_right", T.LongType()),
    T.StructField("rows_common", T.LongType()),
    T.StructField("rows_left_only", T.LongType()),
    T.StructField("rows_right_only", T.LongType()),
    T.StructField("rows_all_equal", T.LongType()),
    T.StructField("rows_some_unequal", T.LongType()),
    T.StructField("error", T.StringType()),
])


def read_day(spark: SparkSession, root: str, spec: TableSpec, load_date: str, folder: str | None = None) -> DataFrame:
    """A stored day; ``folder`` is the table's in that store (the vendor's name, but in the first loader's layout)."""
    folder = folder or spec.original_table
    if spec.dynamic:
        return scan_load_date(spark, root, folder, load_date)
    return scan_snapshot_table(spark, root, folder)


def stored_folders(audit: DataFrame, load_date: str) -> dict[str, str]:
    """Where the day's last load put each table, by its vendor name (one audit row for each table and load)."""
    rows = audit.where((F.col("load_date") == load_date) & (F.col("table_path") != "")).orderBy("loaded_at").select("select_table", "table_path").collect()
    return {r["select_table"]: r["table_path"].split("/")[0] for r in rows}


def reconcile_day(spark: SparkSession, spec: TableSpec, load_date: str, left_root: str,
                  right_root: str, left_name: str = "df_load",
                  right_name: str = "df_opdate", abs_tol: float = 0.0, rel_tol: float = 0.0,
                  left_folder: str | None = None, right_folder: str | None = None) -> Reconciliation:
    """Compare one table's day in two stores by its catalog key (PIP-5)."""
    keys = spec.keys()
    if not keys:
        raise NoKeyError(f"table {spec.table_name} has no key")
    left = read_day(spark, left_root, spec, load_date, left_folder)
    right = read_day(spark, right_root, spec, load_date, right_folder)
    return reconcile(left, right, keys, abs_tol=abs_tol, rel_tol=rel_tol, left_name=left_name,
                     right_name=right_name)


def _tag(df: DataFrame, table: str, load_date: str) -> DataFrame:
    return df.withColumn("table_name", F.lit(table)).withColumn("load_date", F.lit(load_date))


def report_frames(rec: Reconciliation) -> dict[str, DataFrame]:
    """The comparison's outputs, each with a table-independent schema."""
    key_json = F.to_json(F.struct(*[F.col(k) for k in rec.join_keys]))
    unequal = rec.sample_unequal(keep_rank=True).select(
        "column", "rank", key_json.alias("key"), "left_value", "right_value")
    return {"counts": rec.counts(), "columns": rec.columns(), "shape": rec.shape(),
            "schema": rec.schema(), "sample_unequal": unequal,
            "sample_one_sided": rec.sample_one_sided_json("left").unionByName(rec.sample_one_sided_json("right"))}


def render_report(rec: Reconciliation, table: str, load_date: str, keys: list[str] | None = None,
                  frames: dict[str, DataFrame] | None = None) -> str:
    """The comparison as readable text (the reference's per-table report).
    Only the small report frames are collected: one counts row, one row per
    column, at most ten samples per column and side."""
    f = frames or report_frames(rec)
    c = f["counts"].collect()[0].asDict()
    cols = f["columns"].orderBy("column").collect()
    shape = {r["side"]: r for r in f["shape"].collect()}
    schema = f["schema"].collect()
    lines = [f"Comparison of {table} on {load_date}", "",
             "Frames", f"  {'name':<12}{'columns':>10}{'rows':>14}"]
    for side in (rec.left_name, rec.right_name):
        r = shape[side]
        lines.append(f"  {side:<12}{r['n_columns']:>10}{r['n_rows']:>14}")
    common = [r["column"] for r in schema if r["in_left"] and r["in_right"]]
    only_l = [r["column"] for r in schema if r["in_left"] and not r["in_right"]]
    only_r = [r["column"] for r in schema if r["in_right"] and not r["in_left"]]
    lines += ["", "Columns",
              f"  in common: {len(common)}",
              f"  only in {rec.left_name}: {len(only_l)} {only_l}",
              f"  only in {rec.right_name}: {len(only_r)} {only_r}",
              "", "Rows",
              f"  matched on: {', '.join(keys or rec.keys)}",
              f"  repeated keys: {'yes' if rec.repeated_keys() else 'no'}",
              f"  absolute tolerance: {rec.abs_tol}", f"  relative tolerance: {rec.rel_tol}",
              f"  in common: {c['rows_common']}",
              f"  only in {rec.left_name}: {c['rows_left_only']}",
              f"  only in {rec.right_name}: {c['rows_right_only']}",
              f"  with some values unequal: {c['rows_some_unequal']}",
              f"  with all compared values equal: {c['rows_all_equal']}"]
    unequal = [r for r in cols if not r["all_match"]]
    lines += ["", "Column comparison",
              f"  columns with some values unequal: {len(unequal)}",
              f"  columns with all values equal: {len(cols) - len(unequal)}",
              f"  values unequal in total: {sum(r['unequal_cnt'] for r in cols)}"]
    if unequal or any(r["left_type"] != r["right_type"] for r in cols):
        lines += ["", "Columns with unequal values or types",
                  f"  {'column':<24}{'left type':<16}{'right type':<16}{'# unequal':>10}"
                  f"{'max diff':>14}{'# null diff':>12}"]
        for r in cols:
            if r["all_match"] and r["left_type"] == r["right_type"]:
                continue
            lines.append(f"  {r['column']:<24}{r['left_type']:<16}{r['right_type']:<16}"
                         f"{r['unequal_cnt']:>10}{r['max_diff']:>14.6g}{r['null_diff']:>12}")
    samples = f["sample_unequal"].orderBy("column", "rank").collect()
    if samples:
        lines += ["", "Sample rows with unequal values"]
        for r in samples:
            lines.append(f"  {r['column']}  key={r['key']}  {rec.left_name}={r['left_value']}  "
                         f"{rec.right_name}={r['right_value']}")
    for side, name in (("left", rec.left_name), ("right", rec.right_name)):
        rows = f["sample_one_sided"].where(F.col("side") == side).orderBy("rank").collect()
        if rows:
            lines += ["", f"Sample rows only in {name}"] + [f"  {r['row']}" for r in rows]
    return "\n".join(lines) + "\n"


def write_text_report(spark: SparkSession, text: str, log_root: str, table: str,
                      load_date: str) -> str:
    """``<log_root>/<table>/<load_date>.txt``, one file.

    It is written beside its place and renamed into it, so a reader finds the
    last report or the new one, whole; a rerun replaces the day's report."""
    folder = f"{log_root.rstrip('/')}/{table}"
    path = f"{folder}/{load_date}.txt"
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    fs = target.getFileSystem(conf)
    target, staged = fs.makeQualified(target), fs.makeQualified(hadoop.Path(f"{folder}/_{load_date}-{uuid.uuid4().hex}"))
    out = fs.create(staged, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    if fs.exists(target) and fs.getFileStatus(target).isDirectory():  # a report of the older layout
        fs.delete(target, True)
    over = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    over[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(target.toUri(), conf).rename(staged, target, over)
    return path


def write_report(rec: Reconciliation, log_root: str, table: str, load_date: str) -> dict[str, str]:
    """Write every report section under ``log_root/<section>``, replacing
    only this table's day (SNK-7).  The pairs of what differs are kept for the
    duration so they are made once for all sections."""
    joined = rec.changed.persist(StorageLevel.MEMORY_AND_DISK)  # both sides' values only; recomputed if lost
    rec.keep_changed(joined)
    stats = rec.stats().persist()  # one row, shared by counts/columns/shape
    paths = {}
    try:
        frames = report_frames(rec)
        for name, df in frames.items():
            path = f"{log_root.rstrip('/')}/{name}"
            (_tag(df, table, load_date).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic")
             .partitionBy("table_name", "load_date").parquet(path))
            paths[name] = path
        # an empty section has no files, so its schema is given
        written = {name: rec.spark.read.schema(T.StructType([*df.schema.fields, *REPORT_KEYS])).parquet(paths[name])
                   .where((F.col("table_name") == table) & (F.col("load_date") == load_date)) for name, df in frames.items()}
        text = render_report(rec, table, load_date, frames=written)
        paths["text"] = write_text_report(rec.spark, text, log_root, table, load_date)
        rec.report_counts = written["counts"].collect()[0].asDict()
    finally:
        stats.unpersist()
        joined.unpersist()
    return paths


def read_report(spark: SparkSession, log_root: str, section: str) -> DataFrame:
    df = spark.read.parquet(f"{log_root.rstrip('/')}/{section}")
    return df.withColumn("load_date", F.col("load_date").cast(T.StringType()))


def _summary_row(table: str, load_date: str, status: str, counts=None, error=None) -> tuple:
    c = counts or {}
    return (table, load_date, status, c.get("rows_left"), c.get("rows_right"),
            c.get("rows_common"), c.get("rows_left_only"), c.get("rows_right_only"),
            c.get("rows_all_equal"), c.get("rows_some_unequal"), error)


def reconcile_all(spark: SparkSession, specs: list[TableSpec], load_date: str, left_root: str,
                  right_root: str, log_root: str | None = None, threads: int = 5,
                  abs_tol: float = 0.0, rel_tol: float = 0.0) -> DataFrame:
    """Compare every table whose day is present in both stores (PIP-6).

    The table list comes from the two stores' audit rows (SRC-6, SRC-7);
    a table missing on a side is reported, not compared."""
    both = {r["select_table"] for r in
            comparable_tables(read_audit(spark, left_root), read_audit(spark, right_root),
                              load_date).collect()}
    listed = {r["select_table"] for r in
              read_audit(spark, right_root).where(F.col("load_date") == load_date)
              .select("select_table").distinct().collect()}
    by_name = {s.original_table: s for s in specs}
    left_folders, right_folders = (stored_folders(read_audit(spark, root), load_date) for root in (left_root, right_root))

    def run(name: str) -> tuple:
        spec = by_name.get(name)
        if spec is None:
            return _summary_row(name, load_date, "unknown_table")
        if name not in both:
            return _summary_row(name, load_date, "missing")
        if not spec.keys():
            return _summary_row(name, load_date, "no_key")
        try:
            rec = reconcile_day(spark, spec, load_date, left_root, right_root,
                                abs_tol=abs_tol, rel_tol=rel_tol, left_folder=left_folders.get(name), right_folder=right_folders.get(name))
            if log_root:
                write_report(rec, log_root, name, load_date)
                counts = rec.report_counts
            else:
                counts = rec.counts().collect()[0].asDict()
            return _summary_row(name, load_date, "compared", counts)
        except Exception as exc:  # reported, the run goes on
            return _summary_row(name, load_date, "failed",
                                error=f"{type(exc).__name__}: {exc}")

    def pooled(name: str) -> tuple:
        with own_pool(spark, f"reconcile-{name}"):
            return run(name)

    names = sorted(listed)
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        rows = list(pool.map(pooled, names))
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)
