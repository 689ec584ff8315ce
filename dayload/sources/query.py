"""Source scans: a catalog SQL text on the session, or a vendor database over
JDBC (SRC-1, SRC-2)."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from ..catalog import LOAD_DATE_MARKER, TableSpec
from ..vendor_sql import spark_text
from .chunked import CHUNK_ROWS, ChunkedConnection


def scan_sql_query(spark: SparkSession, sql: str, load_date: str | None = None) -> DataFrame:
    """Run a catalog SQL text.  A ``:load_date`` marker is bound as a named
    parameter (never string-formatted into the text)."""
    if load_date is not None and LOAD_DATE_MARKER in sql:
        return spark.sql(sql, args={"load_date": load_date})
    return spark.sql(sql)


def source_frame(spark: SparkSession, spec: TableSpec, load_date: str | None = None,
                 connections: dict[str, "JdbcSource | ChunkedConnection"] | None = None) -> DataFrame:
    """The table's source rows: over JDBC when a connection is registered for
    its vendor family (``data_base``), else as SQL on the session.  Row
    filters applied later are pushed into the JDBC query by Spark."""
    conn = (connections or {}).get(spec.data_base)
    if conn is not None:
        sql = spec.source_sql
        if load_date is not None and LOAD_DATE_MARKER in sql:
            sql = sql.replace(LOAD_DATE_MARKER, f"'{int(load_date)}'")  # digits only
        if isinstance(conn, ChunkedConnection):
            return conn.scan(spark, sql, spec.all_cols)
        return conn.with_bounds(spark, sql).scan(spark, sql)
    return scan_sql_query(spark, spark_text(spec.source_sql), load_date)


def read_connections(spark: SparkSession, path: str) -> dict[str, "JdbcSource | ChunkedConnection"]:
    """``{vendor family: {url, user, password, driver, ...}}`` from a JSON file;
    ``{connect, ...}`` names a DB-API driver's connection instead."""
    text = spark.read.text(path, wholetext=True).collect()[0][0]
    return {family: (ChunkedConnection if "connect" in options else JdbcSource)(**options) for family, options in json.loads(text).items()}


@dataclass(frozen=True)
class JdbcSource:
    """A vendor database reached over JDBC.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` parallel range queries over a ``dbtable`` subquery
    (``query`` cannot be combined with ``partitionColumn``); ``fetchsize``
    bounds the rows per round trip, as the loaders' chunked fetch did."""
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    fetchsize: int = 10_000
    partition_column: str | None = None
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int | None = None

    def options(self, sql: str) -> dict[str, str]:
        # naive vendor times stay naive, whatever zone the JVM runs in
        opts = {"url": self.url, "fetchsize": str(self.fetchsize), "preferTimestampNTZ": "true"}
        for k, v in (("user", self.user), ("password", self.password), ("driver", self.driver)):
            if v is not None:
                opts[k] = v
        if self.partition_column:
            if self.lower_bound is None or self.upper_bound is None or not self.num_partitions:
                raise ValueError("partitioned JDBC read needs bounds and num_partitions")
            opts.update({"dbtable": f"({sql}) src", "partitionColumn": self.partition_column,
                         "lowerBound": str(self.lower_bound), "upperBound": str(self.upper_bound),
                         "numPartitions": str(self.num_partitions)})
        else:
            opts["query"] = sql
        return opts

    def with_bounds(self, spark: SparkSession, sql: str) -> "JdbcSource":
        """Fill missing bounds of the partition column from the source
        itself: one single-row MIN/MAX query run by the database."""
        if not self.partition_column or (self.lower_bound is not None and self.upper_bound is not None):
            return self
        probe = replace(self, partition_column=None, num_partitions=None)
        c = self.partition_column
        row = probe.scan(spark, f"SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM ({sql}) b").collect()[0]
        lo, hi = row["lo"], row["hi"]
        if lo is None:  # empty source: a single range is enough
            return replace(self, partition_column=None, num_partitions=None)
        return replace(self, lower_bound=lo, upper_bound=hi)

    def reader(self, spark: SparkSession, sql: str) -> DataFrameReader:
        return spark.read.format("jdbc").options(**self.options(sql))

    def scan(self, spark: SparkSession, sql: str) -> DataFrame:
        return self.reader(spark, sql).load()
