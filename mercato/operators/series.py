"""Time series: growth, rolling means, streaks, gaps."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato import scratch
from mercato.functions import exact, times

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Row numbers one task expands at a time when a user-day is unrolled.
CHUNK = 4096


def period_growth(
    df: DataFrame, ts: str, value: str, period: str, total: str, previous: str, growth: str
) -> DataFrame:
    """Monthly totals of ``value``, the previous month's total and the growth in percent.

    The window has no partition key, but it runs over one row per month.  Growth is NULL for the
    first month and after a month of zero.
    """
    monthly = df.groupBy(times.month_start(F.col(ts)).alias(period)).agg(
        exact.money(F.sum(value)).alias(total)
    )
    with_previous = monthly.withColumn(
        previous, F.lag(total).over(Window.orderBy(F.col(period).asc_nulls_last()))
    )
    change = F.col(total) - F.col(previous)
    return with_previous.withColumn(growth, exact.percent_money(change, F.col(previous)))


def rolling_mean(
    df: DataFrame, keys: list[str], day: str, value: str, n: int, name: str, frame: str = "rows"
) -> DataFrame:
    """Mean of whole-number ``value`` over the last ``n`` rows (or calendar days) per key.

    ``day`` is a date column with one row per key and day, so a window partition never holds more
    rows than the calendar has days, whatever the traffic of a key.
    """
    window = Window.partitionBy(*keys)
    if frame == "rows":
        window = window.orderBy(F.col(day).asc_nulls_last()).rowsBetween(1 - n, 0)
    elif frame == "days":
        window = window.orderBy(F.unix_date(F.col(day))).rangeBetween(1 - n, 0)
    else:
        raise ValueError(f"frame must be 'rows' or 'days', not {frame!r}")
    return df.withColumn(
        name, exact.mean(F.sum(value).over(window), F.count(value).over(window))
    )


def _islands(days: DataFrame, island: Column, min_len: int) -> DataFrame:
    return (
        days.groupBy("user_id", island.alias("_island"))
        .agg(
            F.min("day").alias("streak_start"),
            F.max("day").alias("streak_end"),
            F.count(F.lit(1)).alias("days"),
        )
        .filter(F.col("days") >= min_len)
        .drop("_island")
    )


def streaks(df: DataFrame, user: str, ts: str, min_len: int = 2, dedupe: bool = True) -> DataFrame:
    """Runs of at least ``min_len`` consecutive active days per user.

    ``dedupe=True`` counts a day once.  ``dedupe=False`` numbers every row of the user before days
    are compared, so a second row on one day shifts the numbering of all later ones.

    Rows are first combined to one per user and day; a user with a third of all rows enters the
    window as at most one row per calendar day.
    """
    by_day = df.groupBy(F.col(user).alias("user_id"), times.day(F.col(ts)).alias("day")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    order = Window.partitionBy("user_id").orderBy(F.col("day").asc_nulls_last())
    if dedupe:
        numbered = by_day.withColumn("number", F.row_number().over(order))
        return _islands(numbered, F.date_sub("day", F.col("number")), min_len)

    # A day's rows carry the numbers last-rows+1 .. last.  Unroll them in chunks that are spread
    # over the cluster first, so that one busy user-day is not expanded by a single task.
    spans = by_day.withColumn("last", F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    chunks = spans.select(
        "user_id",
        "day",
        "last",
        F.explode(F.sequence(F.col("last") - F.col("rows") + 1, F.col("last"), F.lit(CHUNK))).alias(
            "first"
        ),
    ).repartition("user_id", "day", "first")
    numbered = chunks.select(
        "user_id",
        "day",
        F.explode(
            F.sequence(F.col("first"), F.least(F.col("first") + (CHUNK - 1), F.col("last")))
        ).alias("number"),
    )
    return _islands(numbered, F.unix_date("day") - F.col("number"), min_len)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gaps between neighbours of one sorted partition, and its first and last event."""
    part = TaskContext.get().partitionId()
    first: tuple | None = None
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        users, at = batch.column(0), batch.column(1).to_numpy()
        ahead, behind = users.slice(1), users.slice(0, len(users) - 1)
        # Events without a user are compared with each other.
        same = pc.fill_null(pc.equal(ahead, behind), False)
        same = pc.or_(same, pc.and_(pc.is_null(ahead), pc.is_null(behind)))
        gaps = pa.array(np.diff(at)).filter(same)
        head = (users[0].as_py(), int(at[0]))
        first = first or head
        if last and last[0] == head[0]:
            gaps = pa.concat_arrays([gaps, pa.array([head[1] - last[1]], pa.int64())])
        last = (users[-1].as_py(), int(at[-1]))
        none = pa.nulls(len(gaps))
        ends = [none.cast(t) for t in (pa.int32(), users.type, pa.int64(), users.type, pa.int64())]
        yield pa.RecordBatch.from_arrays([gaps, *ends], names=GAP_COLUMNS)
    if first:
        values = [pa.nulls(1, pa.int64()), pa.array([part], pa.int32())]
        for user, moment in (first, last):
            values += [pa.array([user], users.type), pa.array([moment], pa.int64())]
        yield pa.RecordBatch.from_arrays(values, names=GAP_COLUMNS)


GAP_COLUMNS = ["gap", "part", "first_user", "first_at", "last_user", "last_at"]


def order_gaps(df: DataFrame, user: str, ts: str, first_gap_only: bool = False) -> DataFrame:
    """Microseconds between consecutive events of a user, as one column ``gap``.

    Events are sorted once, in ranges of (user, moment): a user, or an hour of one, with a third of all
    events fills several ranges.  Each range compares its neighbours; its first event is compared with
    the last one before it, from one stored row per range.
    """
    events = df.select(F.col(user).alias("user_id"), times.micros(F.col(ts)).alias("at")).filter(
        F.col("at").isNotNull()
    )
    if first_gap_only:
        number = F.row_number().over(Window.partitionBy("user_id").orderBy("at"))
        first_two = events.withColumn("number", number).filter(F.col("number") <= 2)
        return (
            first_two.groupBy("user_id")
            .agg((F.max("at") - F.min("at")).alias("gap"), F.count(F.lit(1)).alias("events"))
            .filter(F.col("events") == 2)
            .select("gap")
        )

    # Events equal in both are interchangeable, but must not all fall into one range.
    ranges = events.withColumn("tie", F.monotonically_increasing_id())
    ranges = ranges.repartitionByRange("user_id", "at", "tie").sortWithinPartitions("user_id", "at")
    kind = events.schema["user_id"].dataType.simpleString()
    shape = f"gap bigint, part int, first_user {kind}, first_at bigint, last_user {kind}, last_at bigint"
    stored = scratch.materialize(ranges.select("user_id", "at").mapInArrow(_compared, shape), "gaps")
    # One row per range; the window without a key sees no other.
    ends = Window.orderBy("part")
    across = (
        stored.filter(F.col("part").isNotNull())
        .select(
            F.when(
                F.lag("last_user").over(ends).eqNullSafe(F.col("first_user")),
                F.col("first_at") - F.lag("last_at").over(ends),
            ).alias("gap")
        )
        .filter(F.col("gap").isNotNull())
    )
    return stored.filter(F.col("gap").isNotNull()).select("gap").unionByName(across)
