from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions import exact

# The rounded quotient times 10^digits has to fit a bigint; six digits leave room for 10^12.
whole = st.integers(min_value=-(10**12), max_value=10**12)
count = st.integers(min_value=-(10**12), max_value=10**12)


def rounded(numerator, denominator, digits):
    if denominator == 0:
        return None
    value = Fraction(numerator, denominator) * 10**digits
    units = int(abs(value) + Fraction(1, 2)) * (1 if value >= 0 else -1)
    return Decimal(units).scaleb(-digits)


@settings(max_examples=3, deadline=None, derandomize=True, phases=[Phase.generate])
@given(pairs=st.lists(st.tuples(whole, count), min_size=200, max_size=200))
def test_half_up_is_exact(spark, pairs):
    pairs = pairs + [(1, 0), (5, 1000), (-5, 1000), (15, 1000), (0, 7)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint").coalesce(1)
    columns = [exact.half_up(F.col("n"), F.col("d"), digits) for digits in (0, 1, 2, 6)]
    for (n, d), row in zip(pairs, df.select(*columns).collect()):
        assert list(row) == [rounded(n, d, digits) for digits in (0, 1, 2, 6)]
    narrow = df.select(exact.half_up(F.col("n"), F.col("d"), 2, "bigint")).collect()
    assert [r[0] for r in narrow] == [rounded(n, d, 2) for n, d in pairs]


def test_mean_is_rounded_once(spark):
    df = spark.range(2_000_000).select(
        F.when(F.col("id") == 0, F.lit("9999.99")).otherwise("0.00").cast("decimal(10,2)").alias("x")
    )
    mean, twice = df.agg(
        exact.mean_money(F.sum("x"), F.count("x")), F.round(F.avg("x"), 2)
    ).first()
    assert mean == Decimal("0.00")
    assert twice == Decimal("0.01")  # what rounding an average again would give


def test_money_mean_matches_decimal(spark):
    df = spark.createDataFrame([("1.01",), ("2.02",), ("2.02",)], "t string")
    total = F.sum(F.col("t").cast("decimal(10,2)"))
    found = df.agg(exact.mean_money(total, F.count("t"))).first()[0]
    assert found == (Decimal("5.05") / 3).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_percent_of_nothing_is_null(spark):
    assert spark.range(1).select(exact.percent(F.lit(3), F.lit(0))).first()[0] is None


def test_primitive_division_raises_instead_of_wrapping(spark):
    too_large = spark.range(1).select(exact.mean(F.lit(9 * 10**18), F.lit(1)))
    with pytest.raises(Exception, match="OVERFLOW"):
        too_large.collect()
