"""Keyed comparison of two loads of one table (JOIN-1..4, AGG-1..6, WIN-1,
LIM-1..2, SET-2..3, SCA-10, PRJ-6).

One definition of a pair, whatever the size of a key: the n-th row of a key on
the left meets the n-th row of that key on the right, both sides ordered by the
shared columns and then by their own; a unique key is position 1.  Column names
are case-folded and keys cast to one type first.

Shared columns are ordered by one rule, whatever the size of a key and the
types of its sides: by what the comparison calls equal (zeros without sign, NaN
as missing, numbers of two types as numbers).  So rows that differ only in how a
value is written stand side by side.

Plan shape:
  * building a comparison starts no job; the rows are paired when an output
    first needs them;
  * the keys are dealt by hash into ``2 ** leaf_bits`` ranges, and one aggregate over
    both loads sums up 128-bit digests of the rows of each range, left minus right
    (``ranges``).  A range whose difference is zero holds equal rows: counts, column
    statistics, samples and one-sided rows need its number of rows and no more.
    Only rows of ranges that differ are paired for them; loads that agree cost
    the one narrow shuffle of the sums;
  * a key has no more rows than its range, so a range of more than
    ``hot_group_rows`` is where hot keys may be; only there are keys counted;
  * ordinary keys: both loads are tagged and unioned, shuffled once by key,
    numbered per side by one window, and paired by an aggregate that reuses the
    partitioning; the digests' row counts say into how many tasks the rows go, so
    a task's rows don't grow with the loads;
  * hot keys: identical rows collapse to runs with a count before the shuffle;
    the runs are dealt by ranges of (key, side, ordering), so a key's runs lie
    in ordered bins; sums of the bins give each bin its offset and each run its
    exact position; the axis of positions is cut into blocks, and a window over
    the run boundaries of one (key, block) pairs what stands side by side.
    Ranges and blocks only balance the work: positions don't depend on them;
  * counts and per-column statistics are one global aggregate, weighted by run
    length;
  * samples are ``row_number() <= k``, which Spark turns into a partial
    per-partition top-k before the shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.compare import abs_difference, nan_to_null, null_mismatch, values_equal
from ..functions.types import is_fractional, is_integral, is_numeric
from ..session import scratch_dir

ORD = "__ord"
IN_LEFT = "__in_left"
IN_RIGHT = "__in_right"
STATUS = "_merge"
BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left_only", "right_only"
SIDE = "__side"
POS = "__pos"
MULT = "__mult"
BIN, BLOCK = "__bin", "__blk"

# Rows of one key from which its runs are spread over bins and blocks; up to it one task sorts them.
HOT_GROUP_ROWS = 250_000
# Positions of one key that one window pairs.
BLOCK_ROWS = 250_000
# Cells (rows times columns, two more for each row itself) that one task sorts, on average: 50 bytes each as measured.
TASK_CELLS = 4_000_000
# Rows one task generates per chunk when a long run is expanded back to
# rows; the chunk grows for very long runs so a run has at most
# EXPAND_MAX_CHUNKS chunks (bounding the chunk list built per run).
EXPAND_CHUNK = 100_000
EXPAND_MAX_CHUNKS = 100_000
# Bits of the hash that deal the keys into ranges.  What differs comes to the
# driver as a number for each range; more ranges (20 bits at most) tell scattered
# differences of a very large load apart.
LEAF_BITS, MOST_LEAF_BITS = 16, 20
# Columns above which the per-column statistics are unpivoted before
# aggregating (keeps the generated aggregate code small).
WIDE_COLUMNS = 100
SAMPLE_ROWS = 10
SAMPLE_COLUMNS = 10


class NoKeyError(ValueError):
    pass


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once, with their count (AGG-5)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def hot_keys(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Key values with more than ``hot_rows`` rows on either side, renamed
    ``__hk<i>`` (at most total rows / ``hot_rows`` of them)."""
    both = (left.select(*keys, F.lit(0).alias(SIDE))
            .unionByName(right.select(*[F.col(k).cast(left.schema[k].dataType).alias(k) for k in keys], F.lit(1).alias(SIDE))))
    counted = both.groupBy(SIDE, *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > hot_rows).select(*[F.col(k).alias(f"__hk{i}") for i, k in enumerate(keys)]).distinct()


def common_key_type(name: str, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type both sides of a key are cast to; raises where there is none."""
    if a == b:
        return a
    if is_integral(a) and is_integral(b):
        return T.LongType()
    if is_numeric(a) and is_numeric(b):
        decimal = [t for t in (a, b) if isinstance(t, T.DecimalType)]
        other = [t for t in (a, b) if not isinstance(t, T.DecimalType)]
        if decimal and all(is_integral(t) for t in other):
            scale = max(t.scale for t in decimal)
            whole = max([t.precision - t.scale for t in decimal] + [19 for _ in other])
            if whole + scale <= 38:
                return T.DecimalType(whole + scale, scale)
        return T.DoubleType()
    times = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, times) and isinstance(b, times):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    raise ValueError(f"key {name!r} has no common type: {a.simpleString()} and {b.simpleString()}")


def unsigned_zero(c: Column, t: T.DataType) -> Column:
    return F.when(c == 0, F.lit(0.0).cast(t)).otherwise(c) if is_fractional(t) else c


def _isnan(c: Column, t: T.DataType) -> Column:
    return F.when(c.isNotNull(), F.isnan(c)) if is_fractional(t) else F.lit(None).cast("boolean")


def order_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type in which a shared column is ordered and digested; None for its
    own.  Numbers of two types become numbers, other types text."""
    if a == b:
        return None
    if not (is_numeric(a) and is_numeric(b)):
        return T.StringType()
    return common_key_type("", a, b)


def canonical(c: Column, own: T.DataType, other: T.DataType) -> Column:
    """A shared value such that values the comparison calls equal are equal here."""
    kind = order_type(own, other)
    if kind is None:
        return nan_to_null(c, own)
    return c.cast(kind) if isinstance(kind, T.StringType) else nan_to_null(c, own).cast(kind)


def _digestible(a: T.DataType, b: T.DataType) -> bool:
    """Whether equal digests of a column mean equal values: not for maps, nor where decimals are ordered as doubles."""
    if "map<" in a.simpleString() or "map<" in b.simpleString() or "variant" in a.simpleString() + b.simpleString():
        return False
    return a == b or is_fractional(a) or is_fractional(b) or not isinstance(order_type(a, b), T.DoubleType)


@dataclass(frozen=True)
class Ranges:
    """What the digests of the key ranges say."""

    equal_rows: int          # rows of either side in ranges that agree
    differing: list[int]     # ranges that don't
    heavy: list[int]         # ranges with more rows on a side than a key may have without being hot
    occupied: int
    rows: int = 0            # rows of both sides
    differing_rows: int = 0  # those in ranges that don't agree
    heavy_rows: int = 0      # those in heavy ranges

    @property
    def whole(self) -> bool:
        """Most ranges differ: telling them apart is not worth it."""
        return 2 * len(self.differing) > self.occupied


def leaf_of(keys: list[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), 64 - bits).cast("int")


def _leaf_in(keys: list[str], bits: int, leaves: list[int]) -> Column:
    """Whether a row's range is one of ``leaves``: a bit in a constant of ``2 ** bits`` bits."""
    if not leaves:
        return F.lit(False)
    words = [0] * max(1, (1 << bits) // 32)
    for x in leaves:
        words[x >> 5] |= 1 << (x & 31)
    table = F.expr(f"CAST(split('{','.join(map(str, words))}', ',') AS ARRAY<BIGINT>)")  # folded once
    leaf = leaf_of(keys, bits)
    bit = F.call_function("shiftright", F.get(table, F.shiftright(leaf, 5)), leaf.bitwiseAND(F.lit(31)))
    return bit.bitwiseAND(F.lit(1).cast("long")) == 1


@dataclass
class Reconciliation:
    spark: SparkSession
    keys: list[str]
    left_cols: list[str]
    right_cols: list[str]
    compare: list[tuple[str, T.DataType, T.DataType]]
    left: DataFrame
    right: DataFrame
    left_name: str = "left"
    right_name: str = "right"
    abs_tol: float = 0.0
    rel_tol: float = 0.0
    hot_group_rows: int = HOT_GROUP_ROWS
    block_rows: int = BLOCK_ROWS
    leaf_bits: int = LEAF_BITS
    _pairs: dict = field(default_factory=dict, repr=False)  # by whether only what differs is paired: (pairs, weighted)
    _ranges: Ranges | None = field(default=None, repr=False)
    _stats: DataFrame | None = field(default=None, repr=False)
    report_counts: dict | None = field(default=None, repr=False)

    @property
    def join_keys(self) -> list[str]:
        """What identifies a pair: the key and the position within it."""
        return [*self.keys, ORD]

    def digests(self) -> DataFrame:
        """One row for each range of keys that holds rows: rows of both sides and the difference of their digests."""
        def tagged(df: DataFrame, side: int) -> DataFrame:
            values = [canonical(F.col(c), *((lt, rt) if side == 0 else (rt, lt))) for c, lt, rt in self.compare]
            missing = [v.isNull() for v in values] + [F.col(k).isNull() for k in self.keys]
            keys = [F.col(k) for k in self.keys]
            return df.select(leaf_of(self.keys, self.leaf_bits).alias("leaf"), F.lit(1 - 2 * side).cast("long").alias("sign"),
                             F.xxhash64(*keys, *values, *missing).alias("a"), F.xxhash64(F.lit(1), *missing, *values[::-1], *keys).alias("b"))
        low = F.lit(0xFFFFFFFF).cast("long")
        # halves of 32 bits: sums stay whole; where they don't fit, null, which never agrees
        halves = [h for c in ("a", "b") for h in (F.col(c).bitwiseAND(low), F.shiftrightunsigned(c, 32))]
        both = tagged(self.left, 0).unionByName(tagged(self.right, 1))
        return both.groupBy("leaf").agg(
            F.count_if(F.col("sign") > 0).alias("n_left"), F.count_if(F.col("sign") < 0).alias("n_right"),
            *[F.try_sum(F.col("sign") * h).alias(f"d{i}") for i, h in enumerate(halves)])

    def ranges(self) -> Ranges:
        """The ranges of keys that agree and those that don't: one aggregate of both loads, one row to the driver."""
        if self._ranges is None:
            agrees = F.col("n_left") == F.col("n_right")
            for i in range(4):
                agrees = agrees & F.coalesce(F.col(f"d{i}") == 0, F.lit(False))
            if not all(_digestible(lt, rt) for _, lt, rt in self.compare):
                agrees = F.lit(False)
            heavy = F.greatest("n_left", "n_right") > self.hot_group_rows
            row = self.digests().withColumn("agrees", agrees).agg(
                F.coalesce(F.sum(F.when(F.col("agrees"), F.col("n_left"))), F.lit(0)).alias("equal"),
                F.collect_list(F.when(~F.col("agrees"), F.col("leaf"))).alias("differing"),
                F.collect_list(F.when(heavy, F.col("leaf"))).alias("heavy"), F.count(F.lit(1)).alias("n"),
                *[F.coalesce(F.sum(F.when(c, F.col("n_left") + F.col("n_right"))), F.lit(0)).alias(name)
                  for name, c in (("rows", F.lit(True)), ("differing_rows", ~F.col("agrees")), ("heavy_rows", heavy))]).first()
            self._ranges = Ranges(row["equal"], row["differing"], row["heavy"], row["n"], row["rows"], row["differing_rows"], row["heavy_rows"])
        return self._ranges

    def _paired(self, changed: bool) -> tuple[DataFrame, bool]:
        """(one row per pair, or per run of equal pairs (``MULT`` of them from
        ``POS`` on), whether there are runs); ``changed``: only ranges that differ."""
        found = self.ranges()
        changed = changed and not found.whole
        if changed not in self._pairs:
            left, right, heavy = self.left, self.right, found.heavy
            if changed:
                differs = set(found.differing)
                kept = _leaf_in(self.keys, self.leaf_bits, found.differing)
                left, right, heavy = left.where(kept), right.where(kept), [x for x in heavy if x in differs]
            shared = [c for c, _, _ in self.compare]
            hot = self._hot_keys(heavy)
            columns = max(len(self.left_cols), len(self.right_cols))
            tasks = _tasks(self.spark, found.differing_rows if changed else found.rows, columns)
            pairs = pair_rows(left, right, self.keys, shared, tasks) if hot is None else \
                pair_split(left, right, self.keys, shared, hot, self.block_rows, tasks, _tasks(self.spark, found.heavy_rows, columns))
            status = (F.when(F.col(IN_LEFT) & F.col(IN_RIGHT), F.lit(BOTH))
                      .when(F.col(IN_LEFT), F.lit(LEFT_ONLY)).otherwise(F.lit(RIGHT_ONLY)))
            self._pairs[changed] = pairs.withColumn(STATUS, status), hot is not None
        return self._pairs[changed]

    @property
    def joined(self) -> DataFrame:
        """All pairs of both loads."""
        return self._paired(False)[0]

    @property
    def changed(self) -> DataFrame:
        """The pairs of the ranges that differ (all pairs where most do)."""
        return self._paired(True)[0]

    def keep_changed(self, df: DataFrame) -> None:
        """Use ``df`` (the same rows, stored somewhere) for the pairs of the ranges that differ."""
        self._pairs[not self.ranges().whole] = df, self._paired(True)[1]
        self._stats = None

    @property
    def _agreeing(self) -> int:
        """Rows that are not in ``changed``, because their ranges agree."""
        found = self.ranges()
        return 0 if found.whole else found.equal_rows

    def _hot_keys(self, heavy: list[int]) -> DataFrame | None:
        """The keys with more than ``hot_group_rows`` rows on a side, None if
        there are none; only rows of ``heavy`` ranges are counted."""
        if not heavy:
            return None
        here = _leaf_in(self.keys, self.leaf_bits, heavy)
        path = scratch_dir(self.spark, "hot-keys")
        hot_keys(self.left.where(here), self.right.where(here), self.keys, self.hot_group_rows).write.parquet(path)
        hot = self.spark.read.parquet(path)
        return hot if hot.limit(1).count() else None

    def repeated_keys(self) -> bool:
        """Whether a key occurs more than once on a side."""
        return any(duplicate_keys(df, self.keys).limit(1).count() for df in (self.left, self.right))

    def _equal(self, name: str, lt: T.DataType, rt: T.DataType) -> Column:
        return values_equal(F.col(f"{name}__l"), F.col(f"{name}__r"), lt, rt, self.abs_tol, self.rel_tol)

    def _difference(self, name: str, lt: T.DataType, rt: T.DataType) -> Column:
        diff = abs_difference(F.col(f"{name}__l"), F.col(f"{name}__r"), lt, rt)
        return diff if diff is not None else F.lit(0.0)

    def _null_mismatch(self, name: str, lt: T.DataType, rt: T.DataType) -> Column:
        return null_mismatch(F.col(f"{name}__l"), F.col(f"{name}__r"), lt, rt)

    def _all_equal(self) -> Column:
        whole = F.lit(True)
        for c in self.compare:
            whole = whole & self._equal(*c)
        return whole

    # ---- row-level outputs -----------------------------------------------------
    def rows(self, limit: int | None = None, changed: bool = False) -> DataFrame:
        """The joined pairs (``changed``: of the ranges that differ), one row each.  Runs of identical pairs are
        expanded in chunks of at most ``EXPAND_CHUNK`` rows spread over all
        tasks; with ``limit`` at most that many rows per run are produced
        (enough for any top-``limit`` sample)."""
        joined, weighted = self._paired(changed)
        if not weighted:
            return joined.withColumn(ORD, F.col(POS) + 1)
        m = F.col(MULT)
        if limit is not None:
            expanded = joined.withColumn("__i", F.explode(F.sequence(
                F.lit(0).cast("long"), F.least(m, F.lit(limit).cast("long")) - 1)))
        else:
            per = F.ceil(m / F.lit(EXPAND_MAX_CHUNKS)).cast("long")
            c = F.greatest(F.lit(EXPAND_CHUNK).cast("long"), per)
            last_chunk = ((m - 1) - (m - 1) % c) / c
            chunks = joined.withColumn("__c", F.explode(F.sequence(
                F.lit(0).cast("long"), last_chunk.cast("long"))))
            n_parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            spread = chunks.repartition(n_parts)
            expanded = spread.withColumn("__i", F.explode(F.sequence(
                F.col("__c") * c, F.least(m, (F.col("__c") + 1) * c) - 1)))
        return expanded.withColumn(ORD, F.col(POS) + F.col("__i") + 1)

    def status(self) -> DataFrame:
        """Every key (and ordinal) with where it occurs (JOIN-1)."""
        return self.rows().select(*self.join_keys, STATUS)

    def left_only(self) -> DataFrame:
        """Rows only in the left load, its own columns (JOIN-2)."""
        return self._one_side(self.rows(changed=True), "left")

    def right_only(self) -> DataFrame:
        """Rows only in the right load, its own columns (JOIN-3)."""
        return self._one_side(self.rows(changed=True), "right")

    def _one_side(self, rows: DataFrame, side: str) -> DataFrame:
        status, cols = (LEFT_ONLY, self.left_cols) if side == "left" else (RIGHT_ONLY, self.right_cols)
        return rows.where(F.col(STATUS) == status).select(*[self._side(c, side).alias(c) for c in cols])

    def common(self) -> DataFrame:
        """Rows in both: keys, both values and the match flag per column (JOIN-4)."""
        cols = [F.col(k) for k in self.join_keys]
        for name, lt, rt in self.compare:
            cols += [F.col(f"{name}__l").alias(f"{name}_{self.left_name}"),
                     F.col(f"{name}__r").alias(f"{name}_{self.right_name}"),
                     self._equal(name, lt, rt).alias(f"{name}_match")]
        return self.rows().where(F.col(STATUS) == BOTH).select(*cols)

    def _side(self, c: str, side: str) -> Column:
        if c in self.keys:
            return F.col(c)
        if c in self.right_cols and c in self.left_cols:
            return F.col(f"{c}__l" if side == "left" else f"{c}__r")
        return F.col(f"{c}__lo" if side == "left" else f"{c}__ro")

    # ---- statistics ------------------------------------------------------------
    def _count(self, cond: Column, more: int = 0) -> Column:
        found = F.coalesce(F.sum(F.when(cond, F.col(MULT)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"))
        return found + F.lit(more).cast("long") if more else found

    def stats(self) -> DataFrame:
        """One row: every count and per-column statistic, from one aggregate."""
        if self._stats is not None:
            return self._stats
        both, same = F.col(STATUS) == BOTH, self._agreeing
        aggs = [self._count(F.col(IN_LEFT), same).alias("rows_left"),
                self._count(F.col(IN_RIGHT), same).alias("rows_right"),
                self._count(both, same).alias("rows_common"),
                self._count(F.col(STATUS) == LEFT_ONLY).alias("rows_left_only"),
                self._count(F.col(STATUS) == RIGHT_ONLY).alias("rows_right_only"),
                self._count(both & self._all_equal(), same).alias("rows_all_equal"),
                self._count(both & ~self._all_equal()).alias("rows_some_unequal")]
        if len(self.compare) <= WIDE_COLUMNS:
            for i, c in enumerate(self.compare):
                aggs += [self._count(both & ~self._equal(*c)).alias(f"u{i}"),
                         F.max(F.when(both, self._difference(*c))).alias(f"d{i}"),
                         self._count(both & self._null_mismatch(*c)).alias(f"n{i}")]
        self._stats = self.changed.agg(*aggs)
        return self._stats

    def counts(self) -> DataFrame:
        """Row counts of the comparison (AGG-1)."""
        return self.stats().select("rows_left", "rows_right", "rows_common", "rows_left_only",
                                   "rows_right_only", "rows_all_equal", "rows_some_unequal")

    def columns(self) -> DataFrame:
        """One row per compared column: types, matches, unequal values,
        largest absolute difference, one-sided nulls (AGG-2..4)."""
        if not self.compare:
            return self.spark.createDataFrame([], COLUMN_STATS_SCHEMA)
        if len(self.compare) > WIDE_COLUMNS:
            return self._columns_unpivoted()
        parts = []
        for i, (name, lt, rt) in enumerate(self.compare):
            parts.append(F.struct(
                F.lit(name).alias("column"), F.lit(lt.simpleString()).alias("left_type"),
                F.lit(rt.simpleString()).alias("right_type"),
                (F.col("rows_common") - F.col(f"u{i}")).alias("match_cnt"),
                F.col(f"u{i}").alias("unequal_cnt"),
                F.coalesce(F.col(f"d{i}"), F.lit(0.0)).alias("max_diff"),
                F.col(f"n{i}").alias("null_diff")))
        return (self.stats().select(F.inline(F.array(*parts)))
                .withColumn("all_match", F.col("unequal_cnt") == 0))

    def _columns_unpivoted(self) -> DataFrame:
        both = F.col(STATUS) == BOTH
        cells = F.array(*[F.struct(F.lit(i).alias("i"), self._equal(*c).alias("eq"),
                                   self._difference(*c).alias("diff"), self._null_mismatch(*c).alias("nd"))
                          for i, c in enumerate(self.compare)])
        # Every common row has one cell per column, so a column's cell
        # weight is the number of common rows.
        per = (self.changed.where(both).select(F.col(MULT).alias("__w"), F.inline(cells))
               .groupBy("i").agg(F.sum("__w").alias("rows_common"),
                                 F.sum(F.when(~F.col("eq"), F.col("__w")).otherwise(0)).alias("unequal_cnt"),
                                 F.max("diff").alias("max_diff"),
                                 F.sum(F.when(F.col("nd"), F.col("__w")).otherwise(0)).alias("null_diff")))
        meta = self.spark.createDataFrame(
            [(i, n, lt.simpleString(), rt.simpleString()) for i, (n, lt, rt) in enumerate(self.compare)],
            "i int, column string, left_type string, right_type string")
        zero = F.lit(0).cast("long")
        return (meta.join(per, "i", "left")
                .select("column", "left_type", "right_type",
                        (F.coalesce("rows_common", zero) + F.lit(self._agreeing) - F.coalesce("unequal_cnt", zero)).cast("long")
                        .alias("match_cnt"),
                        F.coalesce("unequal_cnt", zero).cast("long").alias("unequal_cnt"),
                        F.coalesce("max_diff", F.lit(0.0)).alias("max_diff"),
                        F.coalesce("null_diff", zero).cast("long").alias("null_diff"))
                .withColumn("all_match", F.col("unequal_cnt") == 0))

    def shape(self) -> DataFrame:
        """Columns and rows of both loads (AGG-6)."""
        def side(df: DataFrame, name: str) -> DataFrame:
            return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("side"), F.lit(len(df.columns)).alias("n_columns"), "n_rows")
        return side(self.left, self.left_name).unionByName(side(self.right, self.right_name))

    def schema(self) -> DataFrame:
        """Column presence and types on each side (SET-2, SET-3)."""
        lt = {f.name: f.dataType.simpleString() for f in self.left.schema.fields}
        rt = {f.name: f.dataType.simpleString() for f in self.right.schema.fields}
        names = self.left_cols + [c for c in self.right_cols if c not in lt]
        rows = [(c, c in lt, c in rt, lt.get(c), rt.get(c), c in self.keys) for c in names]
        return self.spark.createDataFrame(
            rows, "column string, in_left boolean, in_right boolean, left_type string, "
                  "right_type string, is_key boolean")

    # ---- samples ---------------------------------------------------------------
    def sample_unequal(self, n: int = SAMPLE_ROWS, keep_rank: bool = False) -> DataFrame:
        """Up to ``n`` unequal rows per column, lowest keys first (LIM-1);
        ``keep_rank`` keeps each row's 1-based position as ``rank``."""
        if not self.compare:
            return self.spark.createDataFrame([], "column string")
        both = F.col(STATUS) == BOTH
        cells = F.filter(F.array(*[
            F.when(~self._equal(c, lt, rt), F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__l").cast(T.StringType()).alias("left_value"),
                F.col(f"{c}__r").cast(T.StringType()).alias("right_value")))
            for c, lt, rt in self.compare]), lambda s: s.isNotNull())
        exploded = self.rows(limit=n, changed=True).where(both).select(*self.join_keys, F.inline(cells))
        w = Window.partitionBy("column").orderBy(*[F.col(k).asc_nulls_first() for k in self.join_keys])
        ranked = exploded.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n)
        return ranked.withColumnRenamed("__rn", "rank") if keep_rank else ranked.drop("__rn")

    def sample_one_sided(self, side: str, n: int = SAMPLE_ROWS,
                         n_cols: int = SAMPLE_COLUMNS) -> DataFrame:
        """Up to ``n`` rows found on one side only, first ``n_cols`` columns,
        lowest keys first, then by position within the key (LIM-2)."""
        cols = (self.left_cols if side == "left" else self.right_cols)[:n_cols]
        return self._first_one_sided(side, n).select(*[self._side(c, side).alias(c) for c in cols])

    def _first_one_sided(self, side: str, n: int) -> DataFrame:
        status = LEFT_ONLY if side == "left" else RIGHT_ONLY
        order = [F.col(k).asc_nulls_first() for k in self.join_keys]
        return self.rows(limit=n, changed=True).where(F.col(STATUS) == status).orderBy(*order).limit(n)

    def sample_one_sided_json(self, side: str, n: int = SAMPLE_ROWS,
                              n_cols: int = SAMPLE_COLUMNS) -> DataFrame:
        """The same sample as (side, rank, key, row) with key and row as JSON;
        the key is whole wherever its columns stand."""
        cols = (self.left_cols if side == "left" else self.right_cols)[:n_cols]
        rank = F.row_number().over(Window.orderBy(*[F.col(k).asc_nulls_first() for k in self.join_keys]))
        return self._first_one_sided(side, n).select(
            F.lit(side).alias("side"), rank.cast("long").alias("rank"),
            F.to_json(F.struct(*[F.col(k) for k in self.keys])).alias("key"),
            F.to_json(F.struct(*[self._side(c, side).alias(c) for c in cols])).alias("row"))


COLUMN_STATS_SCHEMA = ("column string, left_type string, right_type string, match_cnt bigint, "
                       "unequal_cnt bigint, max_diff double, null_diff bigint, all_match boolean")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], abs_tol: float = 0.0,
              rel_tol: float = 0.0, left_name: str = "left", right_name: str = "right",
              hot_group_rows: int = HOT_GROUP_ROWS, block_rows: int = BLOCK_ROWS,
              leaf_bits: int = LEAF_BITS) -> Reconciliation:
    """Pair the rows of two loads by key and compare the shared columns.

    Starts no job.  ``hot_group_rows``, ``block_rows`` and ``leaf_bits`` decide
    how the work is dealt, never what is paired.  Zeros lose their sign."""
    if not 1 <= leaf_bits <= MOST_LEAF_BITS:
        raise ValueError(f"leaf_bits must be between 1 and {MOST_LEAF_BITS}")
    keys = [k.lower() for k in keys if k and k.strip()]
    if not keys:
        raise NoKeyError("comparison needs at least one key column")
    left, right = lower_names(left), lower_names(right)
    for side, df in (("left", left), ("right", right)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"{side} load lacks key columns {missing}")
    for k in keys:
        kind = common_key_type(k, left.schema[k].dataType, right.schema[k].dataType)
        left, right = (df if df.schema[k].dataType == kind else df.withColumn(k, F.col(k).cast(kind)) for df in (left, right))
    left, right = (df.select(*[unsigned_zero(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]) for df in (left, right))
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    compare = [(c, lt[c], rt[c]) for c in left.columns if c in rt and c not in keys]
    return Reconciliation(left.sparkSession, keys, left.columns, right.columns, compare, left, right,
                          left_name, right_name, abs_tol, rel_tol, hot_group_rows, block_rows, leaf_bits)


def _payload(columns: list[str]) -> Column:
    """All columns of a row but its key (never an empty struct)."""
    return F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(True).alias("__row"))


@dataclass(frozen=True)
class _Sides:
    """Column bookkeeping shared by both ways of pairing."""
    keys: list[str]
    shared: list[str]
    lt: dict
    rt: dict
    lpay: list[str]
    rpay: list[str]
    lstruct: T.DataType
    rstruct: T.DataType

    @staticmethod
    def of(left: DataFrame, right: DataFrame, keys: list[str], shared: list[str]) -> "_Sides":
        lpay = [c for c in left.columns if c not in keys]
        rpay = [c for c in right.columns if c not in keys]
        return _Sides(keys, shared, {f.name: f.dataType for f in left.schema.fields},
                      {f.name: f.dataType for f in right.schema.fields}, lpay, rpay,
                      left.select(_payload(lpay).alias("p")).schema[0].dataType,
                      right.select(_payload(rpay).alias("p")).schema[0].dataType)

    @property
    def differing(self) -> list[str]:
        return [c for c in self.shared if self.lt[c] != self.rt[c]]

    def order_copies(self, side: int) -> list[Column]:
        """Shared columns whose types differ are ordered in one type; only
        these get a materialised copy."""
        mine, other = (self.lt, self.rt) if side == 0 else (self.rt, self.lt)
        return [canonical(F.col(c), mine[c], other[c]).alias(f"__o{self.shared.index(c)}") for c in self.differing]

    def payloads(self, side: int) -> list[Column]:
        mine = _payload(self.lpay if side == 0 else self.rpay)
        return [(mine if side == 0 else F.lit(None).cast(self.lstruct)).alias("__pl"),
                (F.lit(None).cast(self.rstruct) if side == 0 else mine).alias("__pr")]

    def shared_value(self, i: int, c: str) -> Column:
        if c in self.differing:
            return F.col(f"__o{i}")
        return nan_to_null(F.coalesce(F.col("__pl").getField(c), F.col("__pr").getField(c)), self.lt[c])

    def ranking(self) -> list[Column]:
        """Side first, then the shared columns, then each side's own columns
        (the other side's are null there), then what the shared order leaves
        open (NaN after missing, decimals that were ordered as doubles);
        without one-sided columns a tie means identical rows."""
        only_l = [c for c in self.lpay if c not in self.rt]
        only_r = [c for c in self.rpay if c not in self.lt]
        left, right = (F.col(p).getField for p in ("__pl", "__pr"))
        nan = [c for c in self.shared if is_fractional(self.lt[c]) or is_fractional(self.rt[c])]
        open_ = [c for c in self.shared if c not in nan and not _digestible(self.lt[c], self.rt[c]) and "map<" not in self.lt[c].simpleString()]
        flags = [F.coalesce(_isnan(left(c), self.lt[c]), _isnan(right(c), self.rt[c]), F.lit(False)).cast("long") for c in nan]
        packed = [reduce(lambda a, b: a * 2 + b, flags[i:i + 60]) for i in range(0, len(flags), 60)]
        return ([F.col(SIDE)]
                + [self.shared_value(i, c).asc_nulls_first() for i, c in enumerate(self.shared)]
                + [left(c).asc_nulls_first() for c in only_l] + [right(c).asc_nulls_first() for c in only_r] + packed
                + [F.coalesce(left(c).cast("string"), right(c).cast("string")).asc_nulls_first() for c in open_])

    def output(self, pl: Column, pr: Column) -> list[Column]:
        return [pl.isNotNull().alias(IN_LEFT), pr.isNotNull().alias(IN_RIGHT),
                *[pl.getField(c).alias(f"{c}__l") for c in self.shared],
                *[pr.getField(c).alias(f"{c}__r") for c in self.shared],
                *[pl.getField(c).alias(f"{c}__lo") for c in self.lpay if c not in self.rt],
                *[pr.getField(c).alias(f"{c}__ro") for c in self.rpay if c not in self.lt]]


def _tasks(spark: SparkSession, rows: int, columns: int) -> int | None:
    """How many tasks sort that many rows; None where the session's shuffle partitions are enough."""
    n = -(-rows * (columns + 2) // TASK_CELLS)
    return n if n > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def _dealt(df: DataFrame, tasks: int | None, by: list[str]) -> DataFrame:
    return df.repartition(tasks, *by) if tasks else df.repartition(*by)


def pair_rows(left: DataFrame, right: DataFrame, keys: list[str], shared: list[str], tasks: int | None = None) -> DataFrame:
    """Pairs of keys that are not hot.  One shuffle: both loads tagged and
    unioned, hash-partitioned by key into ``tasks`` (else the session's
    partitions), numbered per side, paired by an aggregate on (key, position)
    that reuses the partitioning; each group holds at most one row per side."""
    sd = _Sides.of(left, right, keys, shared)

    def tagged(df: DataFrame, side: int) -> DataFrame:
        return df.select(*keys, F.lit(side).alias(SIDE), *sd.order_copies(side), *sd.payloads(side))

    # one exchange of the tagged rows; ordering values are derived after it
    both = _dealt(tagged(left, 0).unionByName(tagged(right, 1)), tasks, keys)
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(*sd.ranking())).cast("long")
    n_left = F.count_if(F.col(SIDE) == 0).over(Window.partitionBy(*keys))
    placed = both.withColumn("__rn", row).withColumn("__nl", n_left).withColumn(
        POS, F.when(F.col(SIDE) == 0, F.col("__rn")).otherwise(F.col("__rn") - F.col("__nl")) - 1)
    paired = placed.groupBy(*keys, POS).agg(F.first("__pl", ignorenulls=True).alias("__pl"),
                                            F.first("__pr", ignorenulls=True).alias("__pr"))
    return paired.select(*keys, POS, F.lit(1).cast("long").alias(MULT), *sd.output(F.col("__pl"), F.col("__pr")))


def _same(a: list[Column], b: list[Column]) -> Column:
    whole = F.lit(True)
    for x, y in zip(a, b):
        whole = whole & x.eqNullSafe(y)
    return whole


def pair_runs(left: DataFrame, right: DataFrame, keys: list[str], shared: list[str], block_rows: int,
              tasks: int | None = None) -> DataFrame:
    """Pairs of hot keys, a row for each stretch of equal pairs.

    1. Identical rows of a side collapse to a run ``(key, row, count)``; the
       partial aggregate runs before the shuffle, so copies never travel.
    2. Ranges of (key, side, ordering) deal the runs into ordered bins.  The
       sums of a key's bins give offsets, a running sum inside the bin the
       rest: every run gets its exact start position on its side.
    3. Positions are cut into blocks of ``block_rows``; a run becomes one
       piece for each block it reaches into.  In a (key, block) each piece is a
       boundary where it starts, and the last piece of a side where it ends; a
       window over the boundaries carries the current row of either side
       forward, which gives the stretches in which one left row meets one
       right row."""
    sd = _Sides.of(left, right, keys, shared)
    spark = left.sparkSession
    lwrap = T.StructType([T.StructField("v", sd.lstruct)])
    rwrap = T.StructType([T.StructField("v", sd.rstruct)])

    def runs(df: DataFrame, side: int) -> DataFrame:
        counted = df.groupBy(*keys, *(sd.lpay if side == 0 else sd.rpay)).agg(F.count(F.lit(1)).alias("__n"))
        return counted.select(*keys, F.lit(side).alias(SIDE), *sd.order_copies(side), *sd.payloads(side), "__n")

    # 2. ordered bins, exact positions
    n_bins = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (runs(left, 0).unionByName(runs(right, 1))
             .repartitionByRange(n_bins, *[F.col(k).asc_nulls_first() for k in keys], *sd.ranking())
             .withColumn(BIN, F.spark_partition_id()))
    path = scratch_dir(spark, "runs")  # bins are read twice and must not move
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    sums = dealt.groupBy(*keys, SIDE, BIN).agg(F.sum("__n").alias("__s"))
    of_side = Window.partitionBy(*keys, SIDE)
    offsets = sums.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(SIDE).alias("__os"), F.col(BIN).alias("__ob"),
        F.coalesce(F.sum("__s").over(of_side.orderBy(BIN).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"),
        F.sum("__s").over(of_side).alias("__total"))
    on = (_same([F.col(k) for k in keys], [F.col(f"__k{i}") for i in range(len(keys))])
          & (F.col(SIDE) == F.col("__os")) & (F.col(BIN) == F.col("__ob")))
    in_bin = Window.partitionBy(*keys, SIDE, BIN).orderBy(*sd.ranking()).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("__n").over(in_bin), F.lit(0).cast("long"))
    placed = (_dealt(dealt, tasks, [*keys, SIDE, BIN]).withColumn("__before", before).join(offsets, on)
              .withColumn("__start", F.col("__off") + F.col("__before")))

    # 3. pieces of blocks, and their boundaries
    size = F.lit(block_rows).cast("long")
    end = F.col("__start") + F.col("__n")
    first, last = F.expr(f"__start div {block_rows}"), F.expr(f"(__start + __n - 1) div {block_rows}")
    pieces = placed.withColumn(BLOCK, F.explode(F.sequence(first, last)))
    lo, hi = F.greatest("__start", F.col(BLOCK) * size), F.least(end, (F.col(BLOCK) + 1) * size)
    pieces = pieces.withColumn("__lo", lo).withColumn("__hi", hi)
    closes = (F.col("__hi") == (F.col(BLOCK) + 1) * size) | (F.col("__hi") == F.col("__total"))
    is_left = F.col(SIDE) == 0
    no_l, no_r = F.lit(None).cast(lwrap), F.lit(None).cast(rwrap)
    # a value is wrapped, so that an end (no row) is still a non-null marker for last(..., ignorenulls)
    start = F.struct(F.col("__lo").alias("pos"), F.lit(1).alias("kind"),
                     F.when(is_left, F.struct(F.col("__pl").alias("v"))).otherwise(no_l).alias("lw"),
                     F.when(~is_left, F.struct(F.col("__pr").alias("v"))).otherwise(no_r).alias("rw"))
    stop = F.when(closes, F.struct(F.col("__hi").alias("pos"), F.lit(0).alias("kind"),
                                   F.when(is_left, F.struct(F.lit(None).cast(sd.lstruct).alias("v"))).otherwise(no_l).alias("lw"),
                                   F.when(~is_left, F.struct(F.lit(None).cast(sd.rstruct).alias("v"))).otherwise(no_r).alias("rw")))
    part = [*keys, BLOCK]
    events = _dealt(pieces.select(*part, F.inline(F.filter(F.array(start, stop), lambda e: e.isNotNull()))), tasks, part)
    by_pos = Window.partitionBy(*part).orderBy("pos", "kind")
    upto = by_pos.rowsBetween(Window.unboundedPreceding, 0)
    carried = (events.withColumn("__cl", F.last("lw", ignorenulls=True).over(upto))
               .withColumn("__cr", F.last("rw", ignorenulls=True).over(upto))
               .withColumn("__np", F.lead("pos").over(by_pos)))
    # the last boundary at a position holds the state of the stretch after it
    settled = carried.where(F.col("__np").isNull() | (F.col("__np") != F.col("pos")))
    stretches = settled.withColumn("__next", F.lead("pos").over(by_pos)).where("__next is not null")
    out = stretches.select(*keys, F.col("pos").alias(POS), (F.col("__next") - F.col("pos")).alias(MULT),
                           *sd.output(F.col("__cl").getField("v"), F.col("__cr").getField("v")))
    return out.where(F.col(IN_LEFT) | F.col(IN_RIGHT))


def pair_split(left: DataFrame, right: DataFrame, keys: list[str], shared: list[str], hot: DataFrame,
               block_rows: int, tasks: int | None = None, hot_tasks: int | None = None) -> DataFrame:
    """Hot keys by runs, all others by rows; both ways give the same pairs."""
    def routed(df: DataFrame, how: str) -> DataFrame:
        on = _same([df[k] for k in keys], [hot[f"__hk{i}"] for i in range(len(keys))])
        return df.join(hot, on, how)

    by_runs = pair_runs(routed(left, "left_semi"), routed(right, "left_semi"), keys, shared, block_rows, hot_tasks)
    by_rows = pair_rows(routed(left, "left_anti"), routed(right, "left_anti"), keys, shared, tasks)
    return by_runs.unionByName(by_rows)
