"""Deterministic top-k, global and per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asc(name: str) -> Column:
    """Ascending, NULL last."""
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    """Descending, NULL first."""
    return F.col(name).desc_nulls_first()


def top_n(df: DataFrame, order: Sequence[Column], n: int, tie: str) -> DataFrame:
    """First ``n`` rows; ``tie`` is a unique column that settles equal ranks.

    Runs as one bounded heap per task and a merge, never as a full sort.
    """
    return df.orderBy(*order, asc(tie)).limit(n)


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, tie: str, rank: str
) -> DataFrame:
    """First ``k`` rows per group with their rank.

    Catalyst cuts each map partition to ``k`` rows per group before the shuffle, so a group
    holding most of the rows still arrives as a handful.
    """
    window = Window.partitionBy(*group).orderBy(*order, asc(tie))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
