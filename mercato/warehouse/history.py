"""Slowly changing dimension, type 2, on plain Parquet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato import scratch
from mercato.functions import times
from mercato.operators.ranks import surrogate_key


def scd2_apply_log(
    dim: DataFrame, log: DataFrame, key: str, attributes: Sequence[str], at: str, surrogate: str
) -> DataFrame:
    """The dimension after a log of changes, any number per entity, each in force from its moment ``at`` on.

    Consecutive changes of an entity become versions that end where the next one starts; a change that
    changes nothing makes none.  An entity's open version is closed by its first real change; unseen
    entities are inserted; all others pass through.  The log is read once and joined once, with the open
    versions alone.  Changes without a moment, two at one moment, or one not later than the version it
    replaces raise.
    """
    state = F.struct(*attributes)
    in_order = Window.partitionBy(key).orderBy(at)
    before = F.lag(state).over(in_order)
    seen = log.select(key, *attributes, at).select(
        key,
        F.col(at).alias("_at"),
        state.alias("_new"),
        (F.lag(at).over(in_order).eqNullSafe(F.col(at)) | F.col(at).isNull()).alias("_unclear"),
        (before.isNull() | ~state.eqNullSafe(before)).alias("_differs"),
    )
    turns = Window.partitionBy(key).orderBy("_at")
    runs = seen.filter("_differs OR _unclear").select(
        key,
        "_at",
        "_new",
        "_unclear",
        F.lead("_at").over(turns).alias("_until"),
        (F.row_number().over(turns) == 1).alias("_first"),
    )
    rest = [c for c in dim.columns if c != key]
    current = dim.filter("is_current").select(key, F.struct(*rest).alias("_old"))
    met = current.join(runs, key, "full_outer")

    def version(new: bool, since: Column, until: Column) -> Column:
        own = {c: F.col(f"_new.{c}" if new else f"_old.{c}") for c in attributes}
        own[surrogate] = F.lit(None).cast(dim.schema[surrogate].dataType) if new else F.col(f"_old.{surrogate}")
        own |= {"valid_from": since, "valid_to": until, "is_current": until.isNull()}
        return F.struct(*[own.get(c, F.col(f"_old.{c}")).alias(c) for c in rest])

    old, first = F.col("_old"), F.coalesce("_first", F.lit(True))
    same = F.coalesce(F.struct(*[F.col(f"_old.{c}").alias(c) for c in attributes]).eqNullSafe(F.col("_new")), F.lit(False))
    # No change, or first one that repeats the open version: that goes on until the next.
    goes_on = old.isNotNull() & first & (F.col("_new").isNull() | same)
    closes = old.isNotNull() & first & ~goes_on
    kept = version(False, F.col("_old.valid_from"), F.when(goes_on, F.col("_until")).otherwise(F.col("_at")))
    opened = version(True, F.col("_at"), F.col("_until"))
    versions = F.when(goes_on, F.array(kept)).when(closes, F.array(kept, opened)).otherwise(F.array(opened))
    early = F.coalesce(closes & (F.col("_at") <= F.col("_old.valid_from")), F.lit(False))
    stored = scratch.materialize(
        met.select(
            key, F.explode(versions).alias("_v"), F.coalesce("_unclear", F.lit(False)).alias("_unclear"), early.alias("_early")
        ).select(key, "_v.*", "_unclear", "_early"),
        "scd2",
    )
    checks = [F.count_if("_unclear"), F.count_if("_early"), F.max(surrogate)]
    unclear, too_early, last_open = stored.agg(*checks).first()
    if unclear:
        raise ValueError(f"changes hold several rows for one {key} and moment, or one without a moment")
    if too_early:
        raise ValueError("a change is not later than the version it replaces")
    closed = dim.filter(~F.col("is_current"))
    last_key = max(last_open or 0, closed.agg(F.max(surrogate)).first()[0] or 0)
    made = surrogate_key(
        stored.filter(F.col(surrogate).isNull()).drop(surrogate, "_unclear", "_early"), [key, "valid_from"], surrogate, start=last_key
    )
    stayed = stored.filter(F.col(surrogate).isNotNull())
    parts = [part.select(*dim.columns) for part in (closed, stayed, made)]
    return reduce(DataFrame.unionByName, parts)


def scd2_apply(
    dim: DataFrame,
    changes: DataFrame,
    key: str,
    attributes: Sequence[str],
    effective: dt.datetime | str,
    surrogate: str,
) -> DataFrame:
    """The dimension after ``changes`` (one row per key) took effect at ``effective``.

    A changed entity gets its current version closed and a new one opened at the same instant;
    unchanged entities pass through, unseen ones are inserted.
    """
    log = changes.select(key, *attributes, times.ntz(effective).alias("_effective"))
    return scd2_apply_log(dim, log, key, attributes, "_effective", surrogate)


def scd2_history(dim: DataFrame, key: str, value: int) -> DataFrame:
    """Every version of one entity, oldest first."""
    return dim.filter(F.col(key) == value).orderBy("valid_from")
