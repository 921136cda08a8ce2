"""Distinct counts from stored sketches: months are counted once and merged into any longer period."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.functions import times

# log2 of a sketch's registers: at most 16 KB a month, whatever it counts.
LOG_REGISTERS = 14
# Three standard errors of such a sketch: what an estimate is off by in all but one of 370 cases.
BOUND = 3 * 1.04 / math.sqrt(1 << LOG_REGISTERS)


def monthly_sketches(
    df: DataFrame, ts: str, counted: Mapping[str, Column | str], sums: Mapping[str, Column] | None = None
) -> DataFrame:
    """One stored row per month with a sketch of every counted column, and sums beside them.

    A NULL is not counted.  Tasks send one sketch per month they see: no key is shuffled.
    """
    sketches = [F.hll_sketch_agg(column, LOG_REGISTERS).alias(name) for name, column in counted.items()]
    totals = [total.alias(name) for name, total in (sums or {}).items()]
    monthly = df.groupBy(times.month_start(F.col(ts)).alias("month")).agg(*sketches, *totals)
    return scratch.materialize(monthly, "sketches")


def estimate(months: DataFrame, names: Sequence[str], keys: Sequence[Column] = (), **sums: Column) -> DataFrame:
    """Estimated distinct counts over the months of each group, and sums; months' sketches are merged."""
    counts = [F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names]
    return months.groupBy(*keys).agg(*counts, *[total.alias(name) for name, total in sums.items()])


def within_bound(estimated: Column, exact: Column) -> Column:
    """Whether an estimate is off by at most ``BOUND`` of the exact count."""
    return F.abs(estimated - exact) <= F.lit(BOUND) * exact
