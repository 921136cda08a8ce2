import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato.operators import series
from mercato.operators.customers import median_gap
from mercato.operators.series import order_gaps, period_growth, rolling_mean, streaks
from tests.conftest import rows

D = dt.date


def stamps(spark, events):
    """(user, day offset or moment) pairs as (user_id, ts)."""
    start = dt.datetime(2024, 1, 1)
    moments = [(u, start + dt.timedelta(days=d)) for u, d in events]
    return spark.createDataFrame(moments, "user_id bigint, ts timestamp_ntz")


def test_growth_guards_first_month_and_zero_base(spark):
    data = [
        (dt.datetime(2024, 1, 5), "60.00"),
        (dt.datetime(2024, 1, 31), "40.00"),
        (dt.datetime(2024, 2, 1), "0.00"),
        (dt.datetime(2024, 3, 9), "50.00"),
        (dt.datetime(2024, 4, 9), "75.00"),
    ]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v string").withColumn(
        "v", F.col("v").cast("decimal(10,2)")
    )
    found = period_growth(df, "ts", "v", "month", "total", "before", "pct").orderBy("month").collect()
    assert [r["pct"] for r in found] == [None, Decimal("-100.00"), None, Decimal("50.00")]
    assert [r["before"] for r in found] == [None, Decimal(100), Decimal(0), Decimal(50)]


def test_rolling_rows_span_gaps_and_days_do_not(spark):
    df = spark.createDataFrame(
        [(1, D(2024, 1, 1), 3), (1, D(2024, 1, 2), 4), (1, D(2024, 1, 10), 9), (2, D(2024, 1, 1), 7)],
        "p int, day date, units bigint",
    )
    by_rows = rolling_mean(df, ["p"], "day", "units", 7, "avg").orderBy("p", "day").collect()
    assert [r["avg"] for r in by_rows] == [Decimal(x) for x in ("3.00", "3.50", "5.33", "7.00")]
    by_days = rolling_mean(df, ["p"], "day", "units", 7, "avg", "days").orderBy("p", "day").collect()
    assert [r["avg"] for r in by_days] == [Decimal(x) for x in ("3.00", "3.50", "9.00", "7.00")]
    with pytest.raises(ValueError):
        rolling_mean(df, ["p"], "day", "units", 7, "avg", "weeks")


def test_streaks_count_a_day_once(spark):
    df = stamps(spark, [(1, 0), (1, 1), (1, 1.5), (1, 2), (1, 5)])
    assert rows(streaks(df, "user_id", "ts")) == [(1, D(2024, 1, 1), D(2024, 1, 3), 3)]


def test_row_streaks_shift_on_a_second_row(spark):
    df = stamps(spark, [(1, 0), (1, 1), (1, 1.5), (1, 2), (1, 5)])
    found = rows(streaks(df, "user_id", "ts", dedupe=False))
    assert found == [
        (1, D(2024, 1, 1), D(2024, 1, 2), 2),
        (1, D(2024, 1, 2), D(2024, 1, 3), 2),
    ]


def row_numbered(df):
    """The row variant as it reads: number every row, then compare days."""
    day = F.col("ts").cast("date")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy(day))
    return (
        df.select("user_id", day.alias("day"), number.alias("n"))
        .distinct()
        .groupBy("user_id", F.date_sub("day", F.col("n")).alias("island"))
        .agg(F.min("day"), F.max("day"), F.count(F.lit(1)).alias("days"))
        .filter("days > 1")
        .drop("island")
    )


@pytest.mark.parametrize("chunk", [1, 7, 4096])
def test_row_streaks_of_a_busy_user(spark, monkeypatch, chunk):
    monkeypatch.setattr(series, "CHUNK", chunk)
    i = F.col("id")
    df = spark.range(3_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 40).cast("bigint").alias("user_id"),
        F.timestamp_add("HOUR", F.abs(F.xxhash64(i)) % 2000, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
    )
    assert rows(streaks(df, "user_id", "ts", dedupe=False)) == rows(row_numbered(df))


def test_gaps_equal_a_plain_lag(spark):
    i = F.col("id")
    df = spark.range(5_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 300).cast("bigint").alias("user_id"),
        F.timestamp_add("MINUTE", F.abs(F.xxhash64(i)) % 50_000, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
    )
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    lagged = df.select((at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts"))).alias("gap"))
    assert rows(order_gaps(df, "user_id", "ts")) == rows(lagged.filter("gap IS NOT NULL"))
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("ts"))
    first = (
        df.withColumn("n", number).withColumn("at", at).filter("n <= 2").groupBy("user_id")
        .agg((F.max("at") - F.min("at")).alias("gap"), F.count("n").alias("c")).filter("c = 2")
    )
    assert rows(order_gaps(df, "user_id", "ts", True)) == rows(first.select("gap"))


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_gaps_across_ranges(spark, parts):
    """A third of all events in one hour of one user, another sixth at one moment, some without a user."""
    i = F.col("id")
    user = F.when(i % 3 == 0, 1).when(i % 3 == 1, F.when(i % 2 == 0, 2)).otherwise(i % 40 + 3).cast("bigint")
    spread = F.abs(F.xxhash64(i)) % F.when(i % 3 == 0, 3_600).when(i % 3 == 1, 1).otherwise(9_000_000)
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    df = spark.range(6_000).select(user.alias("user_id"), F.timestamp_add("SECOND", spread, start).alias("ts"))
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    lagged = df.select((at - F.lag(at).over(Window.partitionBy("user_id").orderBy("ts"))).alias("gap"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = order_gaps(df, "user_id", "ts")
        assert rows(found) == rows(lagged.filter("gap IS NOT NULL"))
        if parts == 16:  # no task holds a fifth of the events, so none of the gaps
            sizes = found.groupBy(F.input_file_name()).count().collect()
            assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 6_000 / 5
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_gaps_of_nothing(spark):
    empty = spark.createDataFrame([], "user_id bigint, ts timestamp_ntz")
    assert order_gaps(empty, "user_id", "ts").count() == 0


def test_median_of_an_even_number_of_gaps(spark):
    df = stamps(spark, [(1, 0), (1, 1), (1, 3), (1, 7), (1, 17)])  # gaps 1, 2, 4, 10
    assert median_gap(df, "user_id", "ts", "d").first()["d"] == Decimal("3.0")
    assert median_gap(df, "user_id", "ts", "d", first_gap_only=True).first()["d"] == Decimal("1.0")


def test_median_without_gaps_is_null(spark):
    assert median_gap(stamps(spark, [(1, 0), (2, 0)]), "user_id", "ts", "d").first()["d"] is None
