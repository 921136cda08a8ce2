"""Dimension and fact builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import times
from mercato.operators.ranks import surrogate_key
from mercato.operators.temporal import temporal_lookup

# What an initial load knows about a customer, and since when a price is known.
UNKNOWN = "Unknown"
FIRST_VALID_FROM = "1900-01-01 00:00:00"
PRICE_KNOWN_FROM = "2024-01-01 00:00:00"


def dim_date(orders: DataFrame, padded_names: bool = False) -> DataFrame:
    """One row per day with an order; attributes are computed per day, not per order."""
    days = (
        orders.select(times.day(F.col("created_at")).alias("full_date"))
        .filter(F.col("full_date").isNotNull())
        .distinct()
    )
    d = F.col("full_date")
    return days.select(
        times.date_id(d).alias("date_id"),
        d,
        times.iso_weekday(d).alias("day_of_week"),
        times.weekday_name(d, padded_names).alias("day_name"),
        F.month(d).alias("month"),
        times.month_name(d, padded_names).alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        times.is_weekend(d).alias("is_weekend"),
    )


def dim_product(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category name and a dense key in product order."""
    names = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    flat = products.join(names, "category_id").select(
        F.col("id").alias("product_id"),
        "category_name",
        F.col("name").alias("product_name"),
        F.col("price").alias("current_price"),
    )
    return surrogate_key(flat, ["product_id"], "product_sk").select(
        "product_sk", "product_id", "category_name", "product_name", "current_price"
    )


def customer_profile(users: DataFrame) -> DataFrame:
    """What the operational tables tell about a customer."""
    return users.select(
        F.col("id").alias("user_id"),
        F.split_part(F.col("email"), F.lit("@"), F.lit(1)).alias("full_name"),
        "email",
        F.lit(UNKNOWN).alias("gender"),
        F.lit(UNKNOWN).alias("city"),
    )


def dim_customer_initial(users: DataFrame) -> DataFrame:
    """First version of every customer: open, current, valid since ever."""
    first = customer_profile(users).select(
        "*",
        times.ntz(FIRST_VALID_FROM).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    keyed = surrogate_key(first, ["user_id"], "customer_sk")
    return keyed.select("customer_sk", *first.columns)


def fct_orders(orders: DataFrame, customers: DataFrame, as_of: bool = False) -> DataFrame:
    """One row per order, all statuses.

    The customer row is the current one, or with ``as_of`` the one valid when the order was placed.
    """
    placed = orders.select(
        F.col("id").alias("order_id"),
        "user_id",
        "created_at",
        times.date_id(F.col("created_at")).alias("date_id"),
        "status",
        "total_amount",
    )
    if as_of:
        versions = customers.select("user_id", "customer_sk", "valid_from", "valid_to")
        joined = temporal_lookup(placed, versions, "user_id", "created_at")
    else:
        joined = placed.join(
            customers.filter("is_current").select("user_id", "customer_sk"), "user_id"
        )
    return joined.select(
        "order_id",
        "customer_sk",
        "date_id",
        "status",
        "total_amount",
        F.lit(0).cast("decimal(10,2)").alias("shipping_cost"),
    )


def line_total() -> Column:
    """The value of an order line."""
    return (F.col("quantity") * F.col("unit_price")).cast("decimal(10,2)")


def fct_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line with its value computed once."""
    dates = orders.select(
        F.col("id").alias("order_id"), times.date_id(F.col("created_at")).alias("date_id")
    )
    return (
        items.join(dates, "order_id")
        .join(products.select("product_id", "product_sk"), "product_id")
        .select(
            F.col("id").alias("order_item_id"),
            "order_id",
            "product_sk",
            "date_id",
            "quantity",
            "unit_price",
            line_total().alias("line_total"),
        )
    )


def price_history_backfill(products: DataFrame, valid_from: str = PRICE_KNOWN_FROM) -> DataFrame:
    """One open price version per product."""
    return products.select(
        F.col("id").alias("product_id"),
        "price",
        times.ntz(valid_from).alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
