"""Daily jobs from the command line (submit with spark-submit or run with
python; cluster settings come from the submitting environment).

    python -m dayload load --catalog CAT.json --root STORE [--date yyyyMMdd]
           [--profile change|business|v1] [--tables NEED.json] [--all]
           [--connections CONN.json] [--column-types DIR]
    python -m dayload reconcile --catalog CAT.json --left STORE_A --right STORE_B
           --log LOG [--date yyyyMMdd] [--abs-tol X] [--rel-tol Y]

Prints one JSON line per table (the audit or comparison summary).  Every table
is tried; the exit code is 1 if any of them failed.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from .catalog import TableSpec, read_catalog, read_column_types, read_keyed_catalog, read_table_list, specs_of
from .functions.timefmt import yesterday
from .plans.load import flagged, listed, load_all
from .plans.reconcile import reconcile_all
from .session import apply_engine_conf
from .sources.query import read_connections


def load_specs(spark: SparkSession, path: str) -> list[TableSpec]:
    """Either catalog layout: a keyed object or an array of table records."""
    head = spark.read.text(path, wholetext=True).collect()[0][0].lstrip()[:1]
    return read_keyed_catalog(spark, path) if head == "{" else specs_of(read_catalog(spark, path))


def with_column_types(spark: SparkSession, spec: TableSpec, folder: str) -> TableSpec:
    """A table whose catalog entry declares no columns takes them from its file."""
    if spec.all_cols:
        return spec
    return replace(spec, all_cols=read_column_types(spark, f"{folder.rstrip('/')}/{spec.table_name}.json"))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    ap = argparse.ArgumentParser(prog="dayload")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--catalog", required=True)
    ld.add_argument("--root", required=True)
    ld.add_argument("--date", default=None)
    ld.add_argument("--profile", default="change", choices=["change", "business", "v1"])
    ld.add_argument("--tables", default=None, help="need_tables list file")
    ld.add_argument("--all", action="store_true", help="every catalog table, not only flagged")
    ld.add_argument("--threads", type=int, default=5)
    ld.add_argument("--connections", default=None, help="JSON file of database connections by vendor family")
    ld.add_argument("--column-types", default=None, help="folder of <table>.json column-type files")
    rc = sub.add_parser("reconcile")
    rc.add_argument("--catalog", required=True)
    rc.add_argument("--left", required=True)
    rc.add_argument("--right", required=True)
    rc.add_argument("--log", default=None)
    rc.add_argument("--date", default=None)
    rc.add_argument("--threads", type=int, default=5)
    rc.add_argument("--abs-tol", type=float, default=0.0, help="numbers equal within this")
    rc.add_argument("--rel-tol", type=float, default=0.0, help="... plus this times |right|")
    args = ap.parse_args(argv)

    spark = spark or apply_engine_conf(SparkSession.builder.appName(f"dayload-{args.cmd}").getOrCreate())
    day = args.date or yesterday()
    specs = load_specs(spark, args.catalog)
    if args.cmd == "load":
        if args.tables:
            chosen = listed(specs, read_table_list(spark, args.tables))
        else:
            chosen = specs if args.all else flagged(specs)
        if args.column_types:
            chosen = [with_column_types(spark, s, args.column_types) for s in chosen]
        connections = read_connections(spark, args.connections) if args.connections else None
        out = load_all(spark, chosen, day, args.root, args.profile, threads=args.threads, connections=connections)
    else:
        out = reconcile_all(spark, specs, day, args.left, args.right, args.log, threads=args.threads,
                            abs_tol=args.abs_tol, rel_tol=args.rel_tol)
    rows = [r.asDict() for r in out.collect()]  # one row per table
    for r in rows:
        print(json.dumps(r, default=str))
    return rows


def exit_code(rows: list[dict]) -> int:
    return int(any(r["status"] == "failed" for r in rows))


if __name__ == "__main__":
    sys.exit(exit_code(main(sys.argv[1:])))
