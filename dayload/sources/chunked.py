"""Bounded fetches as a Spark data source of its own (SRC-2).

``format("dayload_chunks")`` reads a Parquet dataset by row groups, or the
result of a query through any DB-API driver, in chunks of at most
``chunk_rows`` rows: a task holds one chunk at a time, however large its part.

The parts are planned when the query is, after Spark has handed over the
filters it can: row groups that their statistics exclude are never read, and
the bounds that split a database query into ranges are the least and greatest
value among the rows that pass, so a day's load asks for the day's range, not
the table's.  Whole numbers, dates and naive times are compared by the source
alone (``PushedFilters`` in ``explain()``); equality with text is asked of it
and checked again by Spark, since a database may ignore case; fractional columns
are left to Spark, which orders NaN in its own way.

Spark 4.1 keeps the filters that one plan handed to a relation of this kind and
plans the next one with them if that has none to hand over.  So every relation
carries a constant column and a filter on it: each plan hands over at least that
one, and a reader that doesn't see it takes no filter at all.

Options: ``path`` (Parquet), or ``connect`` (``module:function`` returning a
DB-API connection; called on the driver for the bounds and in every task) and
``query``; ``partition_column`` and ``num_partitions``; ``chunk_rows``;
``marker`` (the driver's parameter marker, ``?`` by default).
"""

from __future__ import annotations

import datetime as _dt
import importlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as S
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

FORMAT = "dayload_chunks"
#: The constant column (0), and the only filter on it.
GUARD = "__chunk_guard"
#: Rows of one chunk, as the vendor loads fetch them.
CHUNK_ROWS = 1_000_000
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.TimestampNTZType)
_SIGNS = {S.EqualTo: "=", S.GreaterThan: ">", S.GreaterThanOrEqual: ">=", S.LessThan: "<", S.LessThanOrEqual: "<="}


@dataclass(frozen=True)
class Condition:
    """A filter handed down by Spark: ``column sign value``; sign ``in`` takes a tuple, ``given`` none."""

    column: str
    sign: str
    value: object = None

    @staticmethod
    def of(f: S.Filter) -> "Condition | None":
        if len(f.attribute) != 1:
            return None
        column = f.attribute[0]
        if type(f) in _SIGNS and f.value is not None and f.value == f.value:  # NaN orders differently elsewhere
            return Condition(column, _SIGNS[type(f)], f.value)
        if isinstance(f, S.In) and f.value and all(v is not None and v == v for v in f.value):
            return Condition(column, "in", tuple(f.value))
        return Condition(column, "given") if isinstance(f, S.IsNotNull) else None

    def may_hold(self, least, greatest) -> bool:
        """Whether a value between the bounds can pass."""
        try:
            if self.sign == "in":
                return any(least <= v <= greatest for v in self.value)
            return {"=": lambda v: least <= v <= greatest, ">": lambda v: greatest > v, ">=": lambda v: greatest >= v,
                    "<": lambda v: least < v, "<=": lambda v: least <= v, "given": lambda v: True}[self.sign](self.value)
        except TypeError:  # bounds of another kind than the value
            return True

    def expression(self):
        import pyarrow.compute as pc

        c = pc.field(self.column)
        if self.sign == "given":
            return c.is_valid()
        if self.sign == "in":
            return c.isin(list(self.value))
        return {"=": c.__eq__, ">": c.__gt__, ">=": c.__ge__, "<": c.__lt__, "<=": c.__le__}[self.sign](self.value)

    def text(self, marker: str) -> tuple[str, list]:
        if self.sign == "given":
            return f"{self.column} IS NOT NULL", []
        if self.sign == "in":
            return f"{self.column} IN ({', '.join([marker] * len(self.value))})", list(self.value)
        return f"{self.column} {self.sign} {marker}", [self.value]


@dataclass
class RowGroups(S.InputPartition):
    path: str
    groups: list[int]


@dataclass
class KeyRange(S.InputPartition):
    """``low <= column < high`` (``high`` itself in the last range); the first one also takes rows without a value."""

    low: object
    high: object
    first: bool
    last: bool


def _connection(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)()


def _parquet(path: str):
    import pyarrow.dataset as ds
    from pyarrow import fs

    url = urlparse(path)
    if url.scheme in ("", "file"):
        return ds.dataset(url.path, format="parquet", exclude_invalid_files=False)
    store, inner = fs.FileSystem.from_uri(path)
    return ds.dataset(inner, filesystem=store, format="parquet")


def _cuts(low, high, n: int) -> list:
    """At most ``n - 1`` values that cut ``[low, high]`` into even ranges; none where the kind has no distances."""
    if isinstance(low, _dt.datetime):
        step = (high - low) / n
    elif isinstance(low, _dt.date):
        step = _dt.timedelta(days=max(1, (high - low).days // n))
    elif isinstance(low, int) and not isinstance(low, bool):
        return sorted({low + (high - low) * i // n for i in range(1, n)} - {low, high})
    elif isinstance(low, float):
        step = (high - low) / n
    else:
        return []
    return [c for c in (low + step * i for i in range(1, n)) if low < c < high]


class ChunkReader(S.DataSourceReader):
    def __init__(self, schema: T.StructType, options):
        self.schema, self.options = schema, dict(options)
        self.conditions: list[Condition] = []

    def option(self, name: str, default=None):
        return next((v for k, v in self.options.items() if k.lower() == name), default)

    @property
    def chunk(self) -> int:
        return max(1, int(self.option("chunk_rows", CHUNK_ROWS)))

    def pushFilters(self, filters):
        guarded = any(isinstance(f, S.EqualTo) and f.attribute == (GUARD,) for f in filters)
        for f in filters:
            if guarded and f.attribute == (GUARD,):
                continue
            c = Condition.of(f) if guarded else None
            kind = self.schema[c.column].dataType if c is not None and c.column in self.schema.names else None
            exact = isinstance(kind, _EXACT)
            if exact or isinstance(kind, T.StringType) and c.sign in ("=", "in", "given"):
                self.conditions.append(c)
            if not exact:
                yield f

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c != GUARD]

    def _batch(self, arrays: list, rows: int) -> pa.RecordBatch:
        """One chunk; the constant column is filled in."""
        given = iter(arrays)
        kinds = to_arrow_schema(self.schema)
        return pa.RecordBatch.from_arrays([pa.array(np.zeros(rows, np.int32)) if f.name == GUARD else next(given).cast(f.type) for f in kinds], schema=kinds)

    # ---- planning --------------------------------------------------------------
    def partitions(self):
        return self._row_groups() if self.option("path") else self._ranges()

    def _row_groups(self) -> list[RowGroups]:
        """Row groups that may hold a row, neighbours of a file together up to a chunk."""
        out = [RowGroups("", [])]
        for fragment in _parquet(self.option("path")).get_fragments():
            held, rows = [], 0
            meta = fragment.metadata
            place = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                if not all(self._group_may(group, place, c) for c in self.conditions):
                    continue
                if held and rows + group.num_rows > self.chunk:
                    out.append(RowGroups(fragment.path, held))
                    held, rows = [], 0
                held.append(g)
                rows += group.num_rows
            if held:
                out.append(RowGroups(fragment.path, held))
        return out[1:] or out

    @staticmethod
    def _group_may(group, place: dict, c: Condition) -> bool:
        stats = group.column(place[c.column]).statistics if c.column in place else None
        return stats is None or not stats.has_min_max or c.may_hold(stats.min, stats.max)

    def _where(self, more: list[tuple[str, list]] = ()) -> tuple[str, list]:
        parts = [c.text(self.option("marker", "?")) for c in self.conditions] + list(more)
        return (" WHERE " + " AND ".join(t for t, _ in parts) if parts else ""), [v for _, values in parts for v in values]

    def _ranges(self) -> list[KeyRange]:
        column, n = self.option("partition_column"), int(self.option("num_partitions", 8))
        if not column or n < 2:
            return [KeyRange(None, None, True, True)]
        where, values = self._where()
        connection = _connection(self.option("connect"))
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT MIN({column}), MAX({column}) FROM ({self.option('query')}) q{where}", values)
            low, high = cursor.fetchone()
        finally:
            connection.close()
        cuts = _cuts(low, high, n) if low is not None else []
        if not cuts:
            return [KeyRange(None, None, True, True)]
        edges = [low, *cuts, high]
        return [KeyRange(a, b, i == 0, i == len(cuts)) for i, (a, b) in enumerate(zip(edges, edges[1:]))]

    # ---- reading ---------------------------------------------------------------
    def read(self, partition) -> Iterator[pa.RecordBatch]:
        return self._read_groups(partition) if isinstance(partition, RowGroups) else self._read_range(partition)

    def _read_groups(self, part: RowGroups) -> Iterator[pa.RecordBatch]:
        if not part.groups:
            return
        exact = None
        for c in self.conditions:
            exact = c.expression() if exact is None else exact & c.expression()
        for fragment in _parquet(self.option("path")).get_fragments():
            if fragment.path == part.path:
                for batch in fragment.subset(row_group_ids=part.groups).to_batches(columns=self.columns, filter=exact, batch_size=min(self.chunk, 1 << 16)):
                    if batch.num_rows:
                        yield self._batch([batch.column(c) for c in self.columns], batch.num_rows)

    def _read_range(self, part: KeyRange) -> Iterator[pa.RecordBatch]:
        marker, more = self.option("marker", "?"), []
        if part.low is not None:
            c = self.option("partition_column")
            low = f"({c} >= {marker} OR {c} IS NULL)" if part.first else f"{c} >= {marker}"
            high = f"({c} {'<=' if part.last else '<'} {marker} OR {c} IS NULL)" if part.first else f"{c} {'<=' if part.last else '<'} {marker}"
            more = [(low, [part.low]), (high, [part.high])]
        where, values = self._where(more)
        kinds = to_arrow_schema(T.StructType([self.schema[c] for c in self.columns]))
        connection = _connection(self.option("connect"))
        try:
            cursor = connection.cursor()
            cursor.arraysize = self.chunk
            cursor.execute(f"SELECT {', '.join(self.columns)} FROM ({self.option('query')}) q{where}", values)
            while rows := cursor.fetchmany(self.chunk):  # the first empty chunk is the end
                yield self._batch([pa.array(c, kinds.field(i).type) for i, c in enumerate(zip(*rows))], len(rows))
        finally:
            connection.close()


class ChunkedSource(S.DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        if not self.options.get("path"):
            raise ValueError("a chunked query needs a schema")
        kinds = _parquet(self.options["path"]).schema
        return from_arrow_schema(kinds.remove_metadata(), prefer_timestamp_ntz=True)

    def reader(self, schema):
        return ChunkReader(schema, self.options)


def _load(spark: SparkSession, options: dict, schema: T.StructType) -> DataFrame:
    spark.dataSource.register(ChunkedSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    guarded = T.StructType([*schema.fields, T.StructField(GUARD, T.IntegerType())])
    return spark.read.format(FORMAT).options(**options).schema(guarded).load().where(F.col(GUARD) == 0).drop(GUARD)


def scan_chunks(spark: SparkSession, path: str, columns: list[str] | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A Parquet dataset in bounded chunks; only ``columns`` are read."""
    spark.dataSource.register(ChunkedSource)
    whole = spark.read.format(FORMAT).option("path", path).load().schema
    return _load(spark, {"path": path, "chunk_rows": chunk_rows}, T.StructType([whole[c] for c in columns]) if columns else whole)


# Spark types of the column types that a catalog records.
DATABASE_TYPES = {"varchar": T.StringType(), "nvarchar": T.StringType(), "char": T.StringType(), "text": T.StringType(), "date": T.DateType(),
                  "datetime": T.TimestampNTZType(), "datetime2": T.TimestampNTZType(), "timestamp": T.TimestampNTZType(), "int": T.LongType(),
                  "integer": T.LongType(), "bigint": T.LongType(), "smallint": T.LongType(), "float": T.DoubleType(), "double": T.DoubleType(),
                  "real": T.DoubleType(), "decimal": T.DoubleType(), "numeric": T.DoubleType(), "bit": T.BooleanType()}


@dataclass(frozen=True)
class ChunkedConnection:
    """A vendor database behind a DB-API driver, usable wherever a ``JdbcSource`` is."""

    connect: str
    partition_column: str | None = None
    num_partitions: int = 8
    chunk_rows: int = CHUNK_ROWS
    marker: str = "?"

    def schema(self, columns) -> T.StructType:
        """The declared columns as their recorded database types say."""
        def kind(name: str) -> T.DataType:
            base = name.lower().split("(")[0].strip()
            if base not in DATABASE_TYPES:
                raise ValueError(f"no Spark type for the database type {name!r}")
            return DATABASE_TYPES[base]
        return T.StructType([T.StructField(c.name, kind(c.database_type)) for c in columns])

    def scan(self, spark: SparkSession, sql: str, columns) -> DataFrame:
        options = {"connect": self.connect, "query": sql, "num_partitions": self.num_partitions, "chunk_rows": self.chunk_rows, "marker": self.marker}
        if self.partition_column:
            options["partition_column"] = self.partition_column
        return _load(spark, options, self.schema(columns))
