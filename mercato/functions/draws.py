"""Repeatable random columns.

A draw is a function of a salt and the row's key, so it is the same under any partitioning, retry
or row order, unlike a seeded random generator per task.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DRAWS_PER_DIGEST = 4
_RANGE = float(1 << 32)


def digest(salt: str | Column, *keys: Column) -> Column:
    salt = F.lit(salt) if isinstance(salt, str) else salt
    return F.md5(F.concat_ws(":", salt, *[k.cast("string") for k in keys]))


def parts(of_digest: Column) -> list[Column]:
    """Four independent numbers in [0, 1) from one digest."""
    words = [F.substring(of_digest, 1 + 8 * i, 8) for i in range(DRAWS_PER_DIGEST)]
    return [F.conv(word, 16, 10).cast("bigint") / F.lit(_RANGE) for word in words]


def uniforms(salt: str | Column, *keys: Column) -> list[Column]:
    return parts(digest(salt, *keys))


def uniform(salt: str | Column, *keys: Column) -> Column:
    return uniforms(salt, *keys)[0]


def whole(draw: Column, low: int, high: int) -> Column:
    """A whole number in [low, high], all equally likely."""
    return F.floor(draw * F.lit(float(high - low + 1))) + F.lit(low)


def amount(draw: Column, low_cents: int, high_cents: int) -> Column:
    """A two-digit amount; both ends in hundredths."""
    cents = whole(draw, low_cents, high_cents).cast("decimal(10,0)")
    return (cents * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def moment(draw: Column, start: Column, seconds: int) -> Column:
    """A whole second in [start, start + seconds)."""
    return F.timestamp_add("SECOND", F.floor(draw * F.lit(float(seconds))), start)


def heavy_tails(salt: str, first: int, count: int, size: int, *keys: Column) -> Column:
    """Array of ``count`` positions 0..size-1 whose popularity falls like Pareto with exponent 2.

    Weights (1-u)^(-1/2) - 1 over u in [0, 1) sum to (1 - sqrt(1-u))^2, whose inverse is closed:
    no cumulative table has to be built, broadcast or searched.
    """
    numbers = F.sequence(
        F.lit(first // DRAWS_PER_DIGEST), F.lit((first + count) // DRAWS_PER_DIGEST - 1)
    )
    digests = F.transform(
        numbers, lambda i: digest(F.concat(F.lit(salt), i.cast("string")), *keys)
    )
    from_top = F.flatten(
        F.transform(digests, lambda d: F.array(*[F.lit(1.0) - F.sqrt(u) for u in parts(d)]))
    )
    return F.transform(
        from_top,
        lambda s: F.least(F.floor(s * s * F.lit(float(size))), F.lit(size - 1).cast("bigint")),
    )
