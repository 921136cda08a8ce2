"""Ten aggregates over one Parquet file of trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import exact
from mercato.operators.summary import grouped_summary
from mercato.plans import Registry
from mercato.sources.shop import Shop

QUESTIONS = Registry()
question = QUESTIONS.question


def _mean(cents: str) -> Column:
    return exact.half_up(F.sum(cents), F.count(cents) * F.lit(100), 6)


@question
def x01_count(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trips, [], {"trips": F.count(F.lit(1))})


@question
def x02_count_by_passengers(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trips, ["passenger_count"], {"trips": F.count(F.lit(1))})


@question
def x03_avg_fare_by_vendor(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trip_cents, ["VendorID"], {"avg_fare": _mean("fare")})


@question
def x04_sum_total_by_payment(shop: Shop) -> DataFrame:
    total = exact.from_cents(F.sum("total"))
    return grouped_summary(shop.trip_cents, ["payment_type"], {"total_amount": total})


@question
def x05_max_distance(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trips, [], {"max_distance": F.max("trip_distance")})


@question
def x06_minmax_tolls(shop: Shop) -> DataFrame:
    return grouped_summary(
        shop.trips, [], {"min_tolls": F.min("tolls_amount"), "max_tolls": F.max("tolls_amount")}
    )


@question
def x07_avg_tip_by_passengers(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trip_cents, ["passenger_count"], {"avg_tip": _mean("tip")})


@question
def x08_count_by_ratecode(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trips, ["RatecodeID"], {"trips": F.count(F.lit(1))})


@question
def x09_sum_extra_by_vendor(shop: Shop) -> DataFrame:
    return grouped_summary(shop.trip_cents, ["VendorID"], {"extra": exact.from_cents(F.sum("extra"))})


@question
def x10_avg_max_fare(shop: Shop) -> DataFrame:
    highest = exact.from_cents(F.max("fare")).cast("decimal(12,2)")
    return grouped_summary(shop.trip_cents, [], {"avg_fare": _mean("fare"), "max_fare": highest})
