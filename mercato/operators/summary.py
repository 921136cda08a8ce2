"""Grouped summaries, nested means and rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import exact


def grouped_summary(
    df: DataFrame,
    keys: Sequence[str | Column],
    measures: Mapping[str, Column],
    having: Column | None = None,
) -> DataFrame:
    """Aggregate ``measures`` per ``keys`` (NULL is a group); map-side combine keeps hot keys cheap."""
    result = df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    return result if having is None else result.filter(having)


def nested_mean(
    df: DataFrame, inner_keys: Sequence[str | Column], measure: Column, name: str, digits: int = 2
) -> DataFrame:
    """Mean over groups of a per-group whole number, as one row."""
    inner = df.groupBy(*inner_keys).agg(measure.alias("_inner"))
    return inner.agg(exact.mean(F.sum("_inner"), F.count("_inner"), digits).alias(name))


def rate(hits: Column, total: Column, digits: int = 2) -> Column:
    """Share of ``hits`` (a summed count) in ``total``, in percent."""
    return exact.percent(hits, total, digits)


def rate_by(
    df: DataFrame, keys: Sequence[str | Column], condition: Column, total: str, hits: str, pct: str
) -> DataFrame:
    """Rows, rows meeting ``condition`` and their percentage per group."""
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total), F.count_if(condition).alias(hits)
    )
    return counted.withColumn(pct, rate(F.col(hits), F.col(total)))


def unmatched(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key never occurs in ``right``.

    The right side is reduced to its distinct keys first, so a key that fills a third of it
    reaches the join as one row.
    """
    seen = right.select(F.col(right_key).alias(key)).distinct()
    return left.join(seen, key, "left_anti")
