"""Customer analytics: funnel, cohorts, RFM, order-gap median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.functions import exact, times
from mercato.operators.ranks import Ordering, add_ntiles, median_of
from mercato.operators.series import order_gaps

# Segment labels, in the order the rules are tried.
CHAMPIONS = "Sampiyonlar"
LOYAL = "Sadik Musteriler"
AT_RISK = "Riskli (Kaybedilmek Uzere)"
LOST = "Kaybedilenler"
OTHER = "Digerleri"


def funnel(base: DataFrame, key: str, stages: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Distinct base keys and how many of them reach each stage, as one row.

    ``stages`` holds (name, frame, key column).  Every side shrinks to its distinct keys and is
    partitioned by that key once; the joins then run without another exchange.
    """
    joined = base.select(F.col(key).alias("_key")).distinct()
    for name, frame, column in stages:
        reached = frame.select(F.col(column).alias("_key")).distinct()
        joined = joined.join(reached.withColumn(name, F.lit(1)), "_key", "left")
    counts = [F.count("_key").alias("base")]
    counts += [F.count(name).alias(name) for name, _, _ in stages]
    return joined.agg(*counts)


def cohort_retention(
    users: DataFrame, user_key: str, signup: str, events: DataFrame, event_user: str, ts: str
) -> DataFrame:
    """Per sign-up month and months since: users active in that month, and the cohort's size.

    Months before the sign-up keep their negative number; empty cells are absent.
    """
    cohorts = users.select(
        F.col(user_key).alias("user_id"), times.month_start(F.col(signup)).alias("cohort_month")
    )
    sizes = cohorts.groupBy("cohort_month").agg(F.count("user_id").alias("total_users"))
    active = events.select(
        F.col(event_user).alias("user_id"), times.month_start(F.col(ts)).alias("active_month")
    ).distinct()
    retained = (
        cohorts.join(active, "user_id")
        .groupBy(
            "cohort_month",
            times.months_between_starts(F.col("active_month"), F.col("cohort_month")).alias(
                "month_number"
            ),
        )
        # (user, month) is unique above, so counting rows counts users.
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    return retained.join(sizes, "cohort_month")


def rfm_scores(
    orders: DataFrame, user: str, ts: str, order_id: str, amount: str, k: int = 4,
    ascending: bool = True,
) -> DataFrame:
    """Recency, frequency and money quantile scores per user.

    ``ascending=True`` gives the best users the highest score, ``False`` gives them 1.  Equal
    values are settled by the user id.
    """
    base = orders.groupBy(F.col(user).alias("user_id")).agg(
        F.max(times.micros(F.col(ts))).alias("last_order"),
        F.count(order_id).alias("frequency"),
        exact.money(F.sum(amount)).alias("monetary"),
    )
    stored = scratch.materialize(base, "rfm")
    return add_ntiles(
        stored,
        {
            "recency_score": Ordering("last_order", "user_id", not ascending),
            "frequency_score": Ordering("frequency", "user_id", not ascending),
            "monetary_score": Ordering("monetary", "user_id", not ascending),
        },
        k,
    )


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """Segment of a user whose best score is 4."""
    return (
        F.when((r == 4) & (f == 4) & (m == 4), CHAMPIONS)
        .when((r >= 3) & (f >= 3), LOYAL)
        .when((r <= 2) & (f >= 3), AT_RISK)
        .when((r == 1) & (f <= 2), LOST)
        .otherwise(OTHER)
    )


def median_gap(
    orders: DataFrame, user: str, ts: str, name: str, digits: int = 1, first_gap_only: bool = False
) -> DataFrame:
    """Median days between consecutive orders of a user, exact, as one row."""
    gaps = order_gaps(orders, user, ts, first_gap_only)
    doubled = median_of(scratch.materialize(gaps, "median"), "gap")
    total = F.lit(doubled).cast("decimal(28,0)")
    days = exact.half_up(total, F.lit(2 * times.DAY_MICROS), digits)
    return orders.sparkSession.range(1).select(days.alias(name))
