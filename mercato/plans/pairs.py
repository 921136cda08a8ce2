"""Ten questions, each asked on the operational tables and on the star.

Facts are summed per key before a dimension is joined, so the join sees one row per product,
customer or day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import exact, times
from mercato.operators.summary import grouped_summary
from mercato.operators.topk import desc, top_n
from mercato.plans import Registry
from mercato.sources.shop import Shop
from mercato.warehouse.load import star_of

QUESTIONS = Registry()
question = QUESTIONS.question


def _money(column: str | Column) -> Column:
    return exact.money(F.sum(column))


def _items_per_product(shop: Shop) -> DataFrame:
    sums = grouped_summary(
        shop.order_items,
        ["product_id"],
        {"revenue": exact.from_cents(F.sum("line_cents")), "units": F.sum("quantity").cast("bigint")},
    )
    return sums.join(shop.named_products, "product_id")


def _star_items_per_product(shop: Shop) -> DataFrame:
    loaded = star_of(shop)
    sums = grouped_summary(
        loaded.table("fct_order_items"),
        ["product_sk"],
        {"revenue": _money("line_total"), "units": F.sum("quantity").cast("bigint")},
    )
    return sums.join(loaded.table("dim_product"), "product_sk")


def _star_orders_per_day(shop: Shop) -> DataFrame:
    loaded = star_of(shop)
    counts = grouped_summary(
        loaded.table("fct_orders"), ["date_id"], {"orders": F.count("order_id")}
    )
    return counts.join(loaded.table("dim_date"), "date_id")


def _orders_per_user(shop: Shop) -> DataFrame:
    sums = grouped_summary(
        shop.orders, ["user_id"], {"orders": F.count("id"), "spent": _money("total_amount")}
    )
    return sums.join(shop.users.select(F.col("id").alias("user_id"), "email"), "user_id")


def _star_orders_per_customer(shop: Shop) -> DataFrame:
    loaded = star_of(shop)
    sums = grouped_summary(
        loaded.table("fct_orders"),
        ["customer_sk"],
        {"orders": F.count("order_id"), "spent": _money("total_amount")},
    )
    return sums.join(loaded.table("dim_customer").select("customer_sk", "email"), "customer_sk")


def _revenue_by_category(lines: DataFrame) -> DataFrame:
    return grouped_summary(lines, ["category_name"], {"revenue": _money("revenue")})


@question
def d01_category_revenue_oltp(shop: Shop) -> DataFrame:
    return _revenue_by_category(_items_per_product(shop))


@question
def d01_category_revenue_dwh(shop: Shop) -> DataFrame:
    return _revenue_by_category(_star_items_per_product(shop))


@question
def d02_orders_by_month_oltp(shop: Shop) -> DataFrame:
    month = F.month("created_at").alias("month")
    return grouped_summary(shop.orders, [month], {"order_count": F.count("id")})


@question
def d02_orders_by_month_dwh(shop: Shop) -> DataFrame:
    return grouped_summary(_star_orders_per_day(shop), ["month"], {"order_count": F.sum("orders")})


def _top5_names(lines: DataFrame) -> DataFrame:
    by_name = grouped_summary(lines, ["product_name"], {"revenue": _money("revenue")})
    return top_n(by_name, [desc("revenue")], 5, "product_name")


@question
def d03_top5_products_revenue_oltp(shop: Shop) -> DataFrame:
    return _top5_names(_items_per_product(shop))


@question
def d03_top5_products_revenue_dwh(shop: Shop) -> DataFrame:
    return _top5_names(_star_items_per_product(shop))


@question
def d04_weekend_split_oltp(shop: Shop) -> DataFrame:
    weekend = times.is_weekend(F.col("created_at")).alias("is_weekend")
    return grouped_summary(shop.orders, [weekend], {"order_count": F.count("id")})


@question
def d04_weekend_split_dwh(shop: Shop) -> DataFrame:
    return grouped_summary(
        _star_orders_per_day(shop), ["is_weekend"], {"order_count": F.sum("orders")}
    )


@question
def d05_revenue_by_quarter_oltp(shop: Shop) -> DataFrame:
    quarter = F.quarter("created_at").alias("quarter")
    revenue = exact.from_cents(F.sum("line_cents"))
    return grouped_summary(shop.sales("created_at"), [quarter], {"revenue": revenue})


@question
def d05_revenue_by_quarter_dwh(shop: Shop) -> DataFrame:
    """The line carries its order's day, so the order fact is not needed."""
    loaded = star_of(shop)
    daily = grouped_summary(
        loaded.table("fct_order_items"), ["date_id"], {"revenue": _money("line_total")}
    )
    return grouped_summary(
        daily.join(loaded.table("dim_date"), "date_id"), ["quarter"], {"revenue": _money("revenue")}
    )


@question
def d05_revenue_by_quarter_of_orders_dwh(shop: Shop) -> DataFrame:
    """The day of the order, not of the line: both facts lie in buckets by order."""
    loaded = star_of(shop)
    lines, orders = (loaded.bucketed(name) for name in ("fct_order_items", "fct_orders"))
    dated = lines.select("order_id", "line_total").join(orders.select("order_id", "date_id"), "order_id")
    daily = grouped_summary(dated, ["date_id"], {"revenue": _money("line_total")})
    return grouped_summary(
        daily.join(loaded.table("dim_date"), "date_id"), ["quarter"], {"revenue": _money("revenue")}
    )


# One quarter, asked month by month.
YEAR, QUARTER = 1997, 2


@question
def d05_months_of_quarter_oltp(shop: Shop) -> DataFrame:
    """The months of one quarter: a range of moments that also bounds the order dates in the files."""
    first, last = 3 * QUARTER - 2, 3 * QUARTER + 1
    orders = shop.orders_from(f"{YEAR}-{first:02d}-01 00:00:00", f"{YEAR}-{last:02d}-01 00:00:00")
    placed = orders.select(F.col("id").alias("order_id"), F.month("created_at").alias("month"))
    revenue = exact.from_cents(F.sum("line_cents"))
    return grouped_summary(shop.raw_items.join(placed, "order_id"), ["month"], {"revenue": revenue})


@question
def d05_months_of_quarter_dwh(shop: Shop) -> DataFrame:
    """Only the folders of the quarter's months are read."""
    loaded = star_of(shop)
    days = loaded.table("dim_date").filter((F.col("year") == YEAR) & (F.col("quarter") == QUARTER))
    lines = loaded.fact_on_days("fct_order_items", days.select("date_id", "month"))
    return grouped_summary(lines, ["month"], {"revenue": _money("line_total")})


def _by_status(orders: DataFrame) -> DataFrame:
    total = F.col("total_amount")
    return grouped_summary(
        orders,
        ["status"],
        {
            "order_count": F.count(total),
            "total_amount": _money(total),
            "avg_amount": exact.mean_money(F.sum(total), F.count(total), 6),
        },
    )


@question
def d06_aov_by_status_oltp(shop: Shop) -> DataFrame:
    return _by_status(shop.orders)


@question
def d06_aov_by_status_dwh(shop: Shop) -> DataFrame:
    return _by_status(star_of(shop).table("fct_orders"))


def _top5_emails(orders: DataFrame, measure: str, name: str) -> DataFrame:
    by_email = grouped_summary(orders, ["email"], {name: F.sum(measure)})
    return top_n(by_email, [desc(name)], 5, "email")


@question
def d07_top5_customers_orders_oltp(shop: Shop) -> DataFrame:
    return _top5_emails(_orders_per_user(shop), "orders", "order_count")


@question
def d07_top5_customers_orders_dwh(shop: Shop) -> DataFrame:
    return _top5_emails(_star_orders_per_customer(shop), "orders", "order_count")


def _units_by_category(lines: DataFrame) -> DataFrame:
    return grouped_summary(lines, ["category_name"], {"units": F.sum("units")})


@question
def d08_category_units_oltp(shop: Shop) -> DataFrame:
    return _units_by_category(_items_per_product(shop))


@question
def d08_category_units_dwh(shop: Shop) -> DataFrame:
    return _units_by_category(_star_items_per_product(shop))


@question
def d09_orders_by_weekday_oltp(shop: Shop) -> DataFrame:
    weekday = times.weekday_name(F.col("created_at")).alias("weekday")
    return grouped_summary(shop.orders, [weekday], {"order_count": F.count("id")})


@question
def d09_orders_by_weekday_dwh(shop: Shop) -> DataFrame:
    days = _star_orders_per_day(shop).withColumnRenamed("day_name", "weekday")
    return grouped_summary(days, ["weekday"], {"order_count": F.sum("orders")})


def _top5_spenders(orders: DataFrame) -> DataFrame:
    by_email = grouped_summary(orders, ["email"], {"total_spent": _money("spent")})
    return top_n(by_email, [desc("total_spent")], 5, "email")


@question
def d10_top5_ltv_oltp(shop: Shop) -> DataFrame:
    return _top5_spenders(_orders_per_user(shop))


@question
def d10_top5_ltv_dwh(shop: Shop) -> DataFrame:
    return _top5_spenders(_star_orders_per_customer(shop))
