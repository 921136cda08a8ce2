"""Selective reads: once on the plain tables, once on a file layout made for them.

A layout is written once per application and state of the folder, as an index would be created once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.functions import times
from mercato.operators.topk import desc, top_n
from mercato.plans import Registry
from mercato.sources.files import (
    curve_bounds,
    one_month,
    read_by_month,
    read_table,
    write_by_month,
    write_clustered,
    write_on_curve,
)
from mercato.sources.shop import Shop

QUESTIONS = Registry()
question = QUESTIONS.question

MONTH, YEAR = 7, 2000
SUFFIX, PREFIX = "example.com", "customer.0000001"
LOOKED_UP_ORDER = 750
CANCELLED_SINCE = "2000-01-01 00:00:00"

_WRITTEN: dict[tuple, DataFrame] = {}


def _layout(shop: Shop, name: str, write: Callable[[str], None], read: Callable[[str], DataFrame]) -> DataFrame:
    key = (shop.spark.sparkContext.applicationId, shop.folder, shop.version, name)
    if key not in _WRITTEN:
        path = scratch.new_path(shop.spark, name)
        write(path)
        _WRITTEN[key] = read(path)
    return _WRITTEN[key]


def _clustered(shop: Shop, name: str, df: DataFrame, columns: list[str], bloom: str | None = None) -> DataFrame:
    return _layout(
        shop,
        name,
        lambda path: write_clustered(df, columns, path, bloom),
        lambda path: read_table(shop.spark, path, df.schema),
    )


@question
def l1_month_filter(shop: Shop) -> DataFrame:
    """July of any year: a function of the column, so every row is looked at."""
    return shop.orders.filter(F.month("created_at") == MONTH)


@question
def l1_range_filter(shop: Shop) -> DataFrame:
    """One July, as a range that also bounds the order dates in the files."""
    return shop.orders_from(f"{YEAR}-{MONTH:02d}-01 00:00:00", f"{YEAR}-{MONTH + 1:02d}-01 00:00:00")


@question
def l1_range_filter_by_month(shop: Shop) -> DataFrame:
    by_month = _layout(
        shop,
        "orders-by-month",
        lambda path: write_by_month(shop.orders, "created_at", path),
        lambda path: read_by_month(shop.spark, path, shop.orders.schema),
    )
    return one_month(by_month, "created_at", YEAR, MONTH)


@question
def l2_email_suffix(shop: Shop) -> DataFrame:
    return shop.users.filter(F.col("email").endswith(SUFFIX))


@question
def l2_email_prefix(shop: Shop) -> DataFrame:
    return shop.users.filter(F.col("email").startswith(PREFIX))


@question
def l2_email_prefix_clustered(shop: Shop) -> DataFrame:
    users = _clustered(shop, "users-by-email", shop.users, ["email"])
    return users.filter(F.col("email").startswith(PREFIX))


REVERSED = "email_reversed"


@question
def l2_email_suffix_clustered(shop: Shop) -> DataFrame:
    """The end of a text is the start of the reversed one, by which the files are ordered."""
    turned = shop.users.withColumn(REVERSED, F.reverse("email"))
    users = _clustered(shop, "users-by-reversed-email", turned, [REVERSED])
    return users.filter(F.col(REVERSED).startswith(SUFFIX[::-1])).drop(REVERSED)


@question
def l3_order_lines_lookup(shop: Shop) -> DataFrame:
    return shop.plain_items.filter(F.col("order_id") == LOOKED_UP_ORDER)


@question
def l3_order_lines_lookup_clustered(shop: Shop) -> DataFrame:
    items = _clustered(shop, "items-by-order", shop.plain_items, ["order_id"], bloom="order_id")
    return items.filter(F.col("order_id") == LOOKED_UP_ORDER)


@question
def l4_top20_orders(shop: Shop) -> DataFrame:
    totals = shop.orders.select("id", "user_id", "total_amount")
    return top_n(totals, [desc("total_amount")], 20, "id")


def _cancelled_lately(orders: DataFrame) -> DataFrame:
    lately = F.col("created_at") >= times.ntz(CANCELLED_SINCE)
    return orders.filter((F.col("status") == "cancelled") & lately).select("id", "total_amount")


@question
def l5_status_date_filter(shop: Shop) -> DataFrame:
    return _cancelled_lately(shop.orders_from(CANCELLED_SINCE))


@question
def l5_status_date_filter_clustered(shop: Shop) -> DataFrame:
    clustered = _clustered(shop, "orders-by-status", shop.orders, ["status", "created_at"])
    return _cancelled_lately(clustered)


# What one layout of the orders is made for, and into how many files.
CURVE_COLUMNS, CURVE_FILES = ("status", "created_at", "total_amount"), 64
_BOUNDS: dict[tuple, dict[str, list]] = {}


def _on_curve(shop: Shop) -> tuple[DataFrame, dict[str, list]]:
    """Orders whose files hold neighbours in status, moment and total, and the bounds between them."""
    key = (shop.spark.sparkContext.applicationId, shop.folder, shop.version)
    if key not in _BOUNDS:
        _BOUNDS.clear()
        _BOUNDS[key] = curve_bounds(shop.orders, CURVE_COLUMNS)
    orders = _layout(
        shop,
        "orders-on-curve",
        lambda path: write_on_curve(shop.orders, _BOUNDS[key], path, CURVE_FILES),
        lambda path: read_table(shop.spark, path, shop.orders.schema),
    )
    return orders, _BOUNDS[key]


@question
def l1_range_filter_curve(shop: Shop) -> DataFrame:
    orders, _ = _on_curve(shop)
    return orders.filter(times.in_month(F.col("created_at"), YEAR, MONTH))


@question
def l4_top20_orders_curve(shop: Shop) -> DataFrame:
    """The largest totals lie above the layout's last bounds: others' files are skipped."""
    orders, bounds = _on_curve(shop)
    totals = orders.select("id", "user_id", "total_amount")
    for bound in reversed(bounds["total_amount"]):
        above = totals.filter(F.col("total_amount") >= F.lit(bound))
        if above.count() >= 20:
            return top_n(above, [desc("total_amount")], 20, "id")
    return top_n(totals, [desc("total_amount")], 20, "id")


@question
def l5_status_date_filter_curve(shop: Shop) -> DataFrame:
    return _cancelled_lately(_on_curve(shop)[0])
