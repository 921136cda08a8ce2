"""Positions in a global order without sorting in one task.

``add_ntiles`` and ``median_of`` need only a few exact order statistics.  They are found by
narrowing: a mergeable quantile sketch per key brackets all wanted positions, exact counts tell
between which of its values, or at which, each position is.  When few rows are left for a position,
one aggregate sorts these and picks the row; when many are, they are narrowed again.  Each step is
an aggregation with one row per task in the exchange: no row is shuffled or fetched, and no value,
however frequent, fills a task.  Usually there are four: sizes, sketches, counts, rows.

``surrogate_key`` numbers every row: a range exchange on the whole key, a number inside each
range, and the offset of each range.  ``surrogate_key_in_groups`` gives the same numbers when the
leading column groups the rows: only one row per group meets the ranges.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato import scratch

# Task functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Size of the quantile sketches: ranks are off by about 2.3 / SKETCH ** 0.9 of the rows.
SKETCH = 4_096
# Rows that one aggregate sorts to pick the wanted one.
PICKED = 16_384
# monotonically_increasing_id keeps the partition above this bit.
SLOT_BITS = 33
# Rows of one group that a task sorts; larger groups are spread over ranges.
LARGE_GROUP = 1 << 20


@dataclass(frozen=True)
class Ordering:
    """Order by a numeric ``key``, then by the unique ``tie`` ascending; NULL is the largest key."""

    key: str
    tie: str | None = None
    descending: bool = False


@dataclass
class _Search:
    """One wanted position and what is known about the row there."""

    order: Ordering
    rank: int  # 1-based, inside the remaining rows
    size: int  # remaining rows
    column: str = ""  # the column being narrowed: the key, then the tie
    low: Any = None  # exclusive bounds on that column
    high: Any = None
    fixed: tuple[bool, Any] = field(default=(False, None))  # key already known, its value
    found: tuple[Any, Any] | None = None

    @property
    def backwards(self) -> bool:
        return self.order.descending and not self.fixed[0]

    def remaining(self) -> Column:
        here = F.col(self.column)
        condition = here.isNotNull()
        if self.fixed[0]:
            condition &= F.col(self.order.key).eqNullSafe(F.lit(self.fixed[1]))
        if self.low is not None:
            condition &= here > F.lit(self.low)
        if self.high is not None:
            condition &= here < F.lit(self.high)
        return condition

    def fix_key(self, value: Any, rank: int, size: int) -> None:
        if self.order.tie is None:
            self.found = (value, None)
            return
        self.fixed, self.column = (True, value), self.order.tie
        self.low = self.high = None
        self.rank, self.size = rank, size

    def settle(self, value: Any, rank: int, size: int) -> None:
        """The wanted row has ``value`` in the narrowed column."""
        if self.fixed[0]:
            self.found = (self.fixed[1], value)
        else:
            self.fix_key(value, rank, size)

    def narrow(self, pivots: Sequence[Any], below: Sequence[int], equal: Sequence[int]) -> None:
        """Pick the part that holds the position; counts are between pivots (below each) and at them."""
        parts, low = [], None
        for pivot, between, same in zip(pivots, below, equal, strict=True):
            parts += [(between, low, pivot), (same, pivot, pivot)]
            low = pivot
        parts.append((self.size - sum(below) - sum(equal), low, None))
        if self.backwards:
            parts.reverse()
        rank = self.rank
        for count, low, high in parts:
            if rank > count:
                rank -= count
                continue
            if low is not None and low == high:
                self.settle(low, rank, count)
                return
            self.low = self.low if low is None else low
            self.high = self.high if high is None else high
            self.rank, self.size = rank, count
            return
        raise AssertionError("position outside the frame")


def _start(searches: list[_Search], nulls: Mapping[str, int]) -> None:
    """NULL keys come last ascending and first descending."""
    for s in searches:
        missing = nulls[s.order.key]
        known = s.size - missing
        s.column = s.order.key
        if s.order.descending:
            if s.rank <= missing:
                s.fix_key(None, s.rank, missing)
            else:
                s.rank, s.size = s.rank - missing, known
        elif s.rank > known:
            s.fix_key(None, s.rank - known, missing)
        else:
            s.size = known


def _quantiles(df: DataFrame, searches: list[_Search], number: int) -> list[list[Any]]:
    """Values around every search's position, from sketches that searches of the same rows share."""
    margin = 2.3 / SKETCH**0.9
    sketches: dict[str, Column] = {}
    of, wanted = [], []
    for s in searches:
        left, here, kind = s.remaining(), F.col(s.column), df.schema[s.column].dataType
        whole = isinstance(kind, T.IntegralType)
        values = F.when(left, here.cast("bigint" if whole else "double"))
        name = str((s.column, s.fixed, s.low, s.high))
        make = F.kll_sketch_agg_bigint if whole else F.kll_sketch_agg_double
        sketches.setdefault(name, make(values, SKETCH))
        at = (s.rank - 0.5) / s.size
        at = 1 - at if s.backwards else at
        points = [min(1.0, max(0.0, at + m * margin)) for m in (-2, -0.5, 0.5, 2)]
        ask = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
        of.append(list(sketches).index(name))
        wanted.append((ask, points))
    draws = []
    if number:
        # A remaining value drawn by lot splits whatever the sketch cannot tell apart.
        for i, s in enumerate(searches):
            lot = F.xxhash64(*[c for c in (s.order.key, s.order.tie) if c], F.lit(number))
            draws.append(F.min_by(s.column, F.when(s.remaining(), lot)).alias(f"r{i}"))
    made = df.agg(*[sketch.alias(f"s{i}") for i, sketch in enumerate(sketches.values())], *draws)
    asked = [
        ask(f"s{n}", F.lit(points)).alias(f"q{i}") for i, (n, (ask, points)) in enumerate(zip(of, wanted, strict=True))
    ]
    row = made.select(*asked, *[f"r{i}" for i in range(len(draws))]).first()
    found = []
    for i, s in enumerate(searches):
        kind = df.schema[s.column].dataType
        values = list(row[f"q{i}"])
        if isinstance(kind, T.DecimalType):
            step = Decimal(1).scaleb(-kind.scale)
            values = [Decimal(v).quantize(step) for v in values]
        inside = [
            v for v in values if (s.low is None or v > s.low) and (s.high is None or v < s.high)
        ]
        found.append(sorted({*inside, *([row[f"r{i}"]] if draws else [])}))
    return found


def _round(df: DataFrame, searches: list[_Search], number: int) -> None:
    """Narrows every search: one pass for pivots, one for exact counts."""
    pivots = _quantiles(df, searches, number)
    counts = []
    for i, s in enumerate(searches):
        left, here, low = s.remaining(), F.col(s.column), F.lit(True)
        for j, pivot in enumerate(pivots[i]):
            value = F.lit(pivot)
            counts += [
                F.count_if(left & low & (here < value)).alias(f"b{i}_{j}"),
                F.count_if(left & (here == value)).alias(f"e{i}_{j}"),
            ]
            low = here > value
    row = df.agg(*counts).first()
    for i, s in enumerate(searches):
        places = range(len(pivots[i]))
        s.narrow(pivots[i], [row[f"b{i}_{j}"] for j in places], [row[f"e{i}_{j}"] for j in places])


def _pick(df: DataFrame, searches: list[_Search]) -> None:
    """Finds the rows of searches of which few rows are left: each sorts its own."""
    found = []
    for i, s in enumerate(searches):
        key, tie = F.col(s.order.key), F.col(s.order.tie) if s.order.tie else F.lit(0)
        by = F.lit(0) if s.fixed[0] else key
        if s.backwards:
            whole = isinstance(df.schema[s.order.key].dataType, T.IntegralType)
            by = F.bitwise_not(key) if whole else -key
        row = F.struct(by.alias("by"), tie.alias("tie"), key.alias("key"))
        rows = F.sort_array(F.collect_list(F.when(s.remaining(), row)))
        found.append(F.element_at(rows, s.rank).alias(f"f{i}"))
    row = df.agg(*found).first()
    for i, s in enumerate(searches):
        s.found = (row[f"f{i}"]["key"], row[f"f{i}"]["tie"] if s.order.tie else None)


def _sizes(df: DataFrame, keys: set[str]) -> tuple[int, dict[str, int]]:
    """Rows, and rows without a value per key."""
    names = sorted(keys)
    missing = [F.count_if(F.col(name).isNull()) for name in names]
    total, *rest = df.agg(F.count(F.lit(1)), *missing).first()
    return total, dict(zip(names, rest))


def rows_at(
    df: DataFrame, wanted: Sequence[tuple[Ordering, int]], size: int, nulls: Mapping[str, int]
) -> list[tuple]:
    """(key, tie) of the row at each 1-based position; ``df`` should be a stored table."""
    searches = [_Search(order, rank, size) for order, rank in wanted]
    _start(searches, nulls)
    number = 0
    while many := [s for s in searches if s.found is None and s.size > PICKED]:
        _round(df, many, number)
        number += 1
    if few := [s for s in searches if s.found is None]:
        _pick(df, few)
    return [s.found for s in searches]


def _after(order: Ordering, cut: tuple) -> Column:
    """The row comes after the row ``cut`` in ``order``."""
    key, tie = F.col(order.key), F.col(order.tie)
    value, tie_value = cut
    same = key.eqNullSafe(F.lit(value)) & (tie > F.lit(tie_value))
    if value is None:
        return same | key.isNotNull() if order.descending else same
    beyond = key < F.lit(value) if order.descending else key.isNull() | (key > F.lit(value))
    return F.coalesce(beyond, F.lit(False)) | same


def add_ntiles(df: DataFrame, specs: Mapping[str, Ordering], k: int) -> DataFrame:
    """One column per spec with the row's bucket 1..k, like NTILE(k) over that order.

    Bucket sizes differ by at most one, larger ones first.  ``df`` should be a stored table.
    """
    size, nulls = _sizes(df, {order.key for order in specs.values()})
    quotient, rest = divmod(size, k)
    ends = [j * quotient + min(j, rest) for j in range(1, k)] if size else []
    wanted = [(order, end) for order in specs.values() for end in ends]
    cuts = iter(rows_at(df, wanted, size, nulls))
    tiles = {}
    for name, order in specs.items():
        tile = F.lit(1)
        for end in ends:
            tile += _after(order, next(cuts)).cast("int")
        tiles[name] = tile.cast("int")
    return df.withColumns(tiles)


def median_of(df: DataFrame, key: str) -> int | None:
    """Twice the exact median of the whole-number column ``key`` (a whole number itself)."""
    size, nulls = _sizes(df, {key})
    known = size - nulls[key]
    if known == 0:
        return None
    middle = [(Ordering(key), (known + 1) // 2), (Ordering(key), known // 2 + 1)]
    (low, _), (high, _) = rows_at(df, middle, size, nulls)
    return low + high


def surrogate_key(df: DataFrame, natural_key: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Dense numbers start+1, start+2, ... in the order of ``natural_key``.

    The rows are range-partitioned by the whole key, so equal leading columns still spread out.
    The numbering inside each range is stored with the rows; a retry cannot change it.
    """
    ordered = (
        df.repartitionByRange(*natural_key)
        .sortWithinPartitions(*natural_key)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    stored = scratch.materialize(ordered, f"key-{name}").withColumn(
        "_range", F.shiftright("_slot", SLOT_BITS).cast("int")
    )
    offset, offsets = start, []
    for range_id, count in sorted(map(tuple, stored.groupBy("_range").count().collect())):
        offsets.append((range_id, offset))
        offset += count
    # One row per shuffle partition: small by construction.
    lookup = df.sparkSession.createDataFrame(offsets, "_range int, _offset bigint")
    inside = F.col("_slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return (
        stored.join(F.broadcast(lookup), "_range")
        .withColumn(name, F.col("_offset") + inside + 1)
        .drop("_range", "_slot", "_offset")
    )


def _totals_before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of one range the rows of the groups before it there."""
    total, number = 0, TaskContext.get().partitionId()
    for batch in batches:
        if not batch.num_rows:
            continue
        group, size, counted = batch.columns
        through = pc.add(pc.cumulative_sum(counted), total)
        before = pc.subtract(through, counted)
        total = through[-1].as_py()
        slots = pa.array([number] * batch.num_rows, pa.int32())
        yield pa.RecordBatch.from_arrays([slots, group, size, counted, before], ["_range", "_group", "_size", "_counted", "_before"])


def surrogate_key_in_groups(df: DataFrame, natural_key: Sequence[str], groups: DataFrame, name: str) -> DataFrame:
    """The numbers that ``surrogate_key`` gives the rows whose leading key column is among ``groups``.

    Rows are numbered inside their group, which needs one exchange on the leading column that joins on it
    reuse; a group's offset is summed from the sizes of those before it, so only a row per group is
    range-partitioned.  Groups of more than ``LARGE_GROUP`` rows go through ``surrogate_key``.
    ``groups`` has one column, in which values may repeat.
    """
    lead, *rest = natural_key
    rows = df.filter(F.col(lead).isNotNull())
    known = groups.select(F.col(groups.columns[0]).alias(lead)).distinct().withColumn("_known", F.lit(True))
    sizes = (
        rows.groupBy(lead)
        .agg(F.count(F.lit(1)).alias("_size"))
        .join(known, lead, "left")
        .select(F.col(lead).alias("_group"), "_size", F.when(F.col("_known"), F.col("_size")).otherwise(0).alias("_counted"))
    )
    kind = df.schema[lead].dataType.simpleString()
    summed = sizes.repartitionByRange("_group").sortWithinPartitions("_group").mapInArrow(
        _totals_before, f"_range int, _group {kind}, _size bigint, _counted bigint, _before bigint"
    )
    stored = scratch.materialize(summed, f"groups-{name}")
    totals = stored.groupBy("_range").agg(F.sum("_counted").alias("total"), F.max("_size").alias("largest")).collect()
    offset, offsets = 0, []
    for r in sorted(totals):
        offsets.append((r["_range"], offset))
        offset += r["total"]
    # One row per shuffle partition: small by construction.
    lookup = df.sparkSession.createDataFrame(offsets, "_range int, _offset bigint")
    placed = stored.join(F.broadcast(lookup), "_range").select(
        F.col("_group").alias(lead), "_size", "_counted", (F.col("_before") + F.col("_offset")).alias("_before")
    )
    large = None
    if any(r["largest"] > LARGE_GROUP for r in totals):
        # A row for at least LARGE_GROUP rows each.
        large = placed.filter(F.col("_size") > LARGE_GROUP).orderBy(lead).collect()
        listed = df.sparkSession.createDataFrame([(r[lead],) for r in large], f"{lead} {kind}")
        everything, rows = rows, rows.join(F.broadcast(listed), lead, "left_anti")
        placed = placed.filter(F.col("_size") <= LARGE_GROUP)
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(lead).orderBy(*rest)))
    counted = placed.filter(F.col("_counted") > 0).select(lead, "_before")
    numbered = ranked.join(counted, lead).withColumn(name, F.col("_before") + F.col("_rank"))
    numbered = numbered.select(*df.columns, name)
    if large is None:
        return numbered
    shifts, seen = [], 0
    for r in large:
        if r["_counted"]:
            shifts.append((r[lead], r["_before"] - seen))
            seen += r["_counted"]
    shift = F.broadcast(df.sparkSession.createDataFrame(shifts, f"{lead} {kind}, _shift bigint"))
    spread = surrogate_key(everything.join(shift, lead, "left_semi"), natural_key, name)
    spread = spread.join(shift, lead).withColumn(name, F.col(name) + F.col("_shift"))
    return numbered.unionByName(spread.select(*df.columns, name))
