"""Lookups in validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import times

# Versions of a key that a fact is compared with one by one.
FEW = 16


def valid_at(ts: Column, valid_from: Column, valid_to: Column) -> Column:
    """``ts`` lies in [valid_from, valid_to); an open end reaches forever."""
    return (ts >= valid_from) & (valid_to.isNull() | (ts < valid_to))


def in_bins(facts: DataFrame, history: DataFrame, key: str, ts: str) -> tuple[DataFrame, DataFrame]:
    """Facts and versions with the time bin ``_bin`` in which they can meet.

    A key with more than ``FEW`` versions has as many bins as versions, over the time they span.  As
    versions of a key do not overlap, they lie in at most twice as many bins as there are; a fact lies in
    one.  Any other key has one bin.
    """
    since, until = times.micros(F.col("valid_from")), times.micros(F.col("valid_to"))
    spans = (
        history.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_bins"), F.min(since).alias("_low"), F.max(F.coalesce(until, since)).alias("_high"))
        .filter(F.col("_bins") > FEW)
        .select(key, "_bins", "_low", F.greatest(F.lit(1), F.ceil((F.col("_high") - F.col("_low")) / F.col("_bins"))).alias("_width"))
    )

    def number(at: Column) -> Column:
        place = F.call_function("div", at - F.col("_low"), F.col("_width"))
        return F.greatest(F.lit(0), F.least(place, F.col("_bins") - 1))

    last = F.coalesce(number(until), F.col("_bins") - 1)
    covered = F.when(F.col("_bins").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(number(since), last))
    versions = history.join(spans, key, "left").withColumn("_bin", F.explode(covered))
    placed = facts.join(spans, key, "left").withColumn(
        "_bin", F.coalesce(number(times.micros(F.col(ts))), F.lit(0).cast("bigint"))
    )
    return placed.select(*facts.columns, "_bin"), versions.select(*history.columns, "_bin")


def temporal_lookup(facts: DataFrame, history: DataFrame, key: str, ts: str) -> DataFrame:
    """Facts with the history row valid at their time; facts without one are dropped.

    An equi-join on ``key`` and time bin with the interval as residual condition: it stays a hash or
    merge join, and a fact meets a few versions however many its key has.  The facts of a hot key with
    many versions spread over its bins; those of any other are split by the adaptive skew join.
    """
    placed, versions = in_bins(facts, history, key, ts)
    met = placed.join(versions, [key, "_bin"]).drop("_bin")
    return met.filter(valid_at(F.col(ts), F.col("valid_from"), F.col("valid_to")))
