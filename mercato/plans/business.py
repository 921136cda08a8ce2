"""The fifty business questions.

Lines are summed per product and orders per user before catalogue or user columns are joined, and
top-k lists are cut before that join: the declared foreign keys guarantee that every cut row finds
its partner (``operators.quality`` audits them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions import exact, times
from mercato.operators.distinct import estimate, monthly_sketches, within_bound
from mercato.operators.customers import cohort_retention, funnel, median_gap, rfm_scores, rfm_segment
from mercato.operators.series import period_growth, rolling_mean, streaks
from mercato.operators.summary import grouped_summary, nested_mean, rate, rate_by, unmatched
from mercato.operators.temporal import temporal_lookup
from mercato.operators.topk import asc, desc, top_k_per_group, top_n
from mercato.plans import Registry
from mercato.sources.shop import Shop

QUESTIONS = Registry()
question = QUESTIONS.question


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum_money(column: str | Column) -> Column:
    return exact.money(F.sum(column))


def _units() -> Column:
    return F.sum("quantity").cast("bigint")


def _emails(shop: Shop) -> DataFrame:
    return shop.users.select(F.col("id").alias("user_id"), "email")


def _per_user(shop: Shop, orders: DataFrame) -> DataFrame:
    return grouped_summary(
        orders,
        ["user_id"],
        {"order_count": F.count("id"), "total_spent": _sum_money("total_amount")},
    )


def _product_sums(shop: Shop, status: str) -> DataFrame:
    return grouped_summary(
        shop.sales(status=status),
        ["product_id"],
        {"line_count": _rows(), "units": _units(), "revenue": exact.from_cents(F.sum("line_cents"))},
    )


@question
def q01_top3_products_by_revenue(shop: Shop) -> DataFrame:
    revenue = _product_sums(shop, "completed").join(shop.named_products, "product_id")
    top = top_k_per_group(revenue, ["category_name"], [desc("revenue")], 3, "product_id", "rank")
    return top.select("category_name", "rank", "product_id", "product_name", "revenue").orderBy(
        "category_name", "rank"
    )


@question
def q02_monthly_growth(shop: Shop) -> DataFrame:
    growth = period_growth(
        shop.orders_in("completed"),
        "created_at",
        "total_amount",
        "month",
        "revenue",
        "previous_revenue",
        "growth_pct",
    )
    return growth.orderBy(asc("month"))


@question
def q03_rfm_segments(shop: Shop) -> DataFrame:
    scores = rfm_scores(
        shop.orders_in("completed"), "user_id", "created_at", "id", "total_amount"
    )
    r, f, m = (F.col(c) for c in ("recency_score", "frequency_score", "monetary_score"))
    return scores.select(
        "user_id", r, f, m,
        F.concat(*[c.cast("string") for c in (r, f, m)]).alias("rfm_code"),
        rfm_segment(r, f, m).alias("segment"),
    ).orderBy(desc("rfm_code"), "user_id")


def _daily_units(shop: Shop) -> DataFrame:
    return grouped_summary(
        shop.sales("created_at", status="completed"),
        ["product_id", times.day(F.col("created_at")).alias("day")],
        {"units": _units()},
    )


def _rolling(daily: DataFrame) -> DataFrame:
    return rolling_mean(daily, ["product_id"], "day", "units", 7, "rolling_avg")


@question
def q04_rolling7_product_sales(shop: Shop) -> DataFrame:
    # Ranges of products serve the window and the final order: one exchange for both.
    return (
        _rolling(_daily_units(shop).repartitionByRange("product_id"))
        .select("product_id", times.day_start(F.col("day")).alias("day"), "units", "rolling_avg")
        .orderBy("product_id", asc("day"))
    )


def _streak_columns(found: DataFrame, as_timestamp: bool) -> DataFrame:
    unit = "timestamp_ntz" if as_timestamp else "date"
    return found.select(
        "user_id",
        F.col("streak_start").cast(unit).alias("streak_start"),
        F.col("streak_end").cast(unit).alias("streak_end"),
        "days",
    ).orderBy(desc("days"), desc("streak_start"), "user_id", "streak_end")


@question
def q05_purchase_streaks(shop: Shop) -> DataFrame:
    found = streaks(shop.orders_in("completed"), "user_id", "created_at")
    return _streak_columns(found, as_timestamp=True)


@question
def q05_purchase_streaks_events(shop: Shop) -> DataFrame:
    return _streak_columns(streaks(shop.purchases, "user_id", "ts"), as_timestamp=True)


@question
def q06_funnel_conversion(shop: Shop) -> DataFrame:
    paid = shop.payments.filter(F.col("status") == "success")
    reached = funnel(
        shop.orders, "id", [("paid", paid, "order_id"), ("shipped", shop.shipments, "order_id")]
    )
    return reached.select(
        F.col("base").alias("total_orders"),
        F.col("paid").alias("paid_orders"),
        rate(F.col("paid"), F.col("base")).alias("payment_rate_pct"),
        F.col("shipped").alias("shipped_orders"),
        rate(F.col("shipped"), F.col("paid")).alias("shipping_rate_pct"),
    )


def _with_email(shop: Shop, rows: DataFrame) -> DataFrame:
    return rows.join(_emails(shop), "user_id")


def _top_users(
    shop: Shop, status_rows: DataFrame, order: list[Column], n: int
) -> DataFrame:
    """The list is cut after the names are joined: a sum without a user must not shorten it."""
    return top_n(_with_email(shop, _per_user(shop, status_rows)), order, n, "user_id")


@question
def q06_funnel_users_approx(shop: Shop) -> DataFrame:
    """Users who ordered, paid and were sent something: exact, and whether one merged row of sketches agrees."""
    paid = shop.payments.filter(F.col("status") == "success").select("order_id", F.lit(True).alias("is_paid"))
    sent = shop.shipments.select("order_id", F.lit(True).alias("is_sent"))
    orders = shop.orders.select(F.col("id").alias("order_id"), "user_id", "created_at")
    reached = orders.join(paid, "order_id", "left").join(sent, "order_id", "left")
    stages = {
        "ordered": F.col("user_id"),
        "paid": F.when(F.col("is_paid"), F.col("user_id")),
        "shipped": F.when(F.col("is_sent"), F.col("user_id")),
    }
    merged = estimate(monthly_sketches(reached, "created_at", stages), list(stages))
    exactly = reached.agg(*[F.count_distinct(column).alias(name) for name, column in stages.items()])
    # Two rows of one number per stage, side by side.
    rows = exactly.withColumn("is_exact", F.lit(True)).unionByName(merged.withColumn("is_exact", F.lit(False)))
    counts = {name: F.max(F.when(F.col("is_exact"), F.col(name))) for name in stages}
    estimates = {name: F.max(F.when(~F.col("is_exact"), F.col(name))) for name in stages}
    return rows.agg(
        *[count.alias(name) for name, count in counts.items()],
        *[within_bound(estimates[name], counts[name]).alias(f"{name}_within_bound") for name in stages],
    )


@question
def q07_top10_customers_by_orders(shop: Shop) -> DataFrame:
    top = _top_users(shop, shop.orders_in("completed"), [desc("order_count")], 10)
    return top.select("email", "order_count", "total_spent")


@question
def q08_never_ordered_users(shop: Shop) -> DataFrame:
    idle = unmatched(shop.users, shop.orders, "id", "user_id")
    return top_n(idle, [desc("created_at")], 50, "id").select("email", "created_at")


def _category_catalogue(shop: Shop) -> DataFrame:
    return grouped_summary(
        shop.catalogue,
        ["category_id", "category_name"],
        {
            "avg_price": exact.mean_money(F.sum("price"), F.count("price")),
            "max_price": F.max("price"),
            "min_price": F.min("price"),
            "total_stock": F.sum("stock").cast("bigint"),
        },
    )


@question
def q09_category_price_stock(shop: Shop) -> DataFrame:
    return (
        _category_catalogue(shop)
        .select("category_name", "avg_price", "total_stock")
        .orderBy(desc("avg_price"), "category_name")
    )


def _top_products(shop: Shop, status: str, n: int) -> DataFrame:
    named = _product_sums(shop, status).join(shop.named_products, "product_id")
    return top_n(named, [desc("units")], n, "product_id")


@question
def q10_top10_returned_products(shop: Shop) -> DataFrame:
    return _top_products(shop, "returned", 10).select(
        "product_name",
        "category_name",
        F.col("line_count").alias("return_lines"),
        F.col("units").alias("returned_units"),
    )


def _per_coupon(shop: Shop) -> DataFrame:
    used = shop.orders_in("completed").filter(F.col("coupon_id").isNotNull())
    return grouped_summary(
        used, ["coupon_id"], {"uses": F.count("id"), "revenue": _sum_money("total_amount")}
    )


def _coupons(shop: Shop) -> DataFrame:
    return shop.coupons.select(F.col("id").cast("bigint").alias("coupon_id"), "code", "discount_pct")


@question
def q11_coupon_performance(shop: Shop) -> DataFrame:
    joined = _coupons(shop).join(_per_coupon(shop), "coupon_id", "left")
    return joined.select(
        "code",
        "discount_pct",
        F.coalesce("uses", F.lit(0)).cast("bigint").alias("uses"),
        exact.money(F.coalesce("revenue", F.lit(0))).alias("revenue"),
    ).orderBy(desc("uses"), "code")


@question
def q12_unsold_products(shop: Shop) -> DataFrame:
    unsold = unmatched(shop.named_products, shop.order_items, "product_id", "product_id")
    return top_n(unsold, [desc("stock")], 50, "product_id").select(
        "product_name", "category_name", "stock", F.col("price").alias("unit_price")
    )


@question
def q13_aov(shop: Shop) -> DataFrame:
    total = F.col("total_amount")
    return grouped_summary(
        shop.orders_in("completed"),
        [],
        {
            "avg_order": exact.mean_money(F.sum(total), F.count(total)),
            "min_order": F.min(total),
            "max_order": F.max(total),
        },
    )


@question
def q14_orders_by_hour(shop: Shop) -> DataFrame:
    by_hour = grouped_summary(
        shop.orders_in("completed"),
        [F.hour("created_at").alias("hour")],
        {"order_count": F.count("id"), "revenue": _sum_money("total_amount")},
    )
    return by_hour.orderBy(desc("order_count"), "hour")


@question
def q15_avg_basket_units(shop: Shop) -> DataFrame:
    return nested_mean(
        shop.sales(status="completed"), ["order_id"], F.sum("quantity"), "avg_basket_units"
    )


@question
def q16_repeat_customers(shop: Shop) -> DataFrame:
    repeat = _per_user(shop, shop.orders_in("completed")).filter(F.col("order_count") > 1)
    return (
        _with_email(shop, repeat)
        .select("user_id", "email", "order_count", F.col("total_spent").alias("lifetime_value"))
        .orderBy(desc("order_count"), "user_id")
    )


@question
def q17_one_time_buyers(shop: Shop) -> DataFrame:
    once = _per_user(shop, shop.orders_in("completed")).filter(F.col("order_count") == 1)
    order = [desc("total_spent")]
    return top_n(_with_email(shop, once), order, 50, "user_id").select(
        "user_id", "email", F.col("total_spent").alias("revenue")
    )


@question
def q18_shipment_status(shop: Shop) -> DataFrame:
    counted = grouped_summary(shop.shipments, ["status"], {"shipment_count": F.count("id")})
    return counted.orderBy(desc("shipment_count"), "status")


def _monthly_orders(orders: DataFrame, count: str, amount: str) -> DataFrame:
    return grouped_summary(
        orders,
        [times.month_start(F.col("created_at")).alias("month")],
        {count: F.count("id"), amount: _sum_money("total_amount")},
    ).orderBy(desc("month"))


@question
def q19_monthly_cancel_cost(shop: Shop) -> DataFrame:
    return _monthly_orders(shop.orders_in("cancelled"), "cancelled_count", "lost_revenue")


@question
def q20_category_revenue(shop: Shop) -> DataFrame:
    sums = _product_sums(shop, "completed").join(shop.named_products, "product_id")
    by_category = grouped_summary(
        sums,
        ["category_name"],
        {"line_count": F.sum("line_count"), "revenue": _sum_money("revenue")},
    )
    return by_category.select("category_name", "line_count", "revenue").orderBy(
        desc("revenue"), "category_name"
    )


@question
def q21_tied_capital(shop: Shop) -> DataFrame:
    value = exact.money(F.col("stock") * F.col("price"))
    stocked = shop.named_products.filter(F.col("stock") > 0).withColumn("value", value)
    return top_n(stocked, [desc("value")], 20, "product_id").select(
        "product_name", "category_name", "stock", F.col("price").alias("unit_price"), "value"
    )


@question
def q22_cohort_retention(shop: Shop) -> DataFrame:
    cells = cohort_retention(
        shop.users, "id", "created_at", shop.orders_in("completed"), "user_id", "created_at"
    )
    return cells.select("cohort_month", "month_number", "retained_users", "total_users").orderBy(
        asc("cohort_month"), "month_number"
    )


@question
def q23_top10_no_coupon_spenders(shop: Shop) -> DataFrame:
    plain = shop.orders_in("completed").filter(F.col("coupon_id").isNull())
    top = _top_users(shop, plain, [desc("total_spent")], 10)
    return top.select("email", "order_count", "total_spent")


@question
def q24_cancellations_by_hour(shop: Shop) -> DataFrame:
    by_hour = grouped_summary(
        shop.orders_in("cancelled"),
        [F.hour("created_at").alias("hour")],
        {"cancelled_count": F.count("id")},
    )
    return by_hour.orderBy(desc("cancelled_count"), "hour")


@question
def q25_category_price_range(shop: Shop) -> DataFrame:
    return (
        _category_catalogue(shop)
        .select("category_name", "max_price", "min_price", "avg_price")
        .orderBy(desc("max_price"), "category_name")
    )


@question
def q26_monthly_new_users(shop: Shop) -> DataFrame:
    return grouped_summary(
        shop.users,
        [times.month_start(F.col("created_at")).alias("month")],
        {"new_users": F.count("id")},
    ).orderBy(desc("month"))


@question
def q27_aov_by_discount(shop: Shop) -> DataFrame:
    by_discount = grouped_summary(
        _per_coupon(shop).join(_coupons(shop), "coupon_id"),
        ["discount_pct"],
        {
            "order_count": F.sum("uses"),
            "avg_order": exact.mean_money(F.sum("revenue"), F.sum("uses")),
        },
    )
    return by_discount.orderBy(desc("discount_pct"))


@question
def q28_critical_stock(shop: Shop) -> DataFrame:
    low = shop.named_products.filter(F.col("stock") < 20)
    return top_n(low, [asc("stock")], 30, "product_id").select(
        "product_name", "category_name", "stock", F.col("price").alias("unit_price")
    )


@question
def q29_avg_daily_orders(shop: Shop) -> DataFrame:
    day = times.day(F.col("created_at"))
    return nested_mean(shop.orders, [day], F.count("id"), "avg_daily_orders", digits=0)


@question
def q30_largest_order(shop: Shop) -> DataFrame:
    placed = _with_email(shop, shop.orders_in("completed"))
    return top_n(placed, [desc("total_amount")], 1, "id").select(
        "email", F.col("id").alias("order_id"), "total_amount", "created_at"
    )


@question
def q31_top5_products_by_units(shop: Shop) -> DataFrame:
    return _top_products(shop, "completed", 5).select("product_name", "category_name", "units")


@question
def q32_category_cancel_rate(shop: Shop) -> DataFrame:
    per_product = grouped_summary(
        shop.sales("status"),
        ["product_id"],
        {"lines": _rows(), "cancelled": F.count_if(F.col("status") == "cancelled")},
    ).join(shop.named_products, "product_id")
    by_category = grouped_summary(
        per_product,
        ["category_name"],
        {"line_count": F.sum("lines"), "cancelled_count": F.sum("cancelled")},
    )
    return by_category.select(
        "category_name",
        "line_count",
        "cancelled_count",
        rate(F.col("cancelled_count"), F.col("line_count")).alias("cancel_rate_pct"),
    ).orderBy(desc("cancel_rate_pct"), "category_name")


@question
def q33_monthly_coupon_trend(shop: Shop) -> DataFrame:
    with_coupon = shop.orders_in("completed").filter(F.col("coupon_id").isNotNull())
    return _monthly_orders(with_coupon, "coupon_orders", "coupon_revenue")


@question
def q34_top10_revenue_days(shop: Shop) -> DataFrame:
    daily = grouped_summary(
        shop.orders_in("completed"),
        [times.day_start(F.col("created_at")).alias("day")],
        {"revenue": _sum_money("total_amount"), "order_count": F.count("id")},
    )
    return top_n(daily, [desc("revenue")], 10, "day")


@question
def q35_unsold_by_category(shop: Shop) -> DataFrame:
    products = shop.products.select(F.col("id").alias("product_id"), "category_id")
    unsold = unmatched(products, shop.order_items, "product_id", "product_id")
    counts = grouped_summary(unsold, ["category_id"], {"unsold_products": _rows()})
    categories = shop.categories.select(F.col("id").alias("category_id"), "name")
    without_products = unmatched(categories, products, "category_id", "category_id").select(
        F.col("name").alias("category_name"), F.lit(0).cast("bigint").alias("unsold_products")
    )
    with_unsold = categories.join(counts, "category_id").select(
        F.col("name").alias("category_name"), "unsold_products"
    )
    return with_unsold.unionByName(without_products)


@question
def q36_arpu(shop: Shop) -> DataFrame:
    per_user = _per_user(shop, shop.orders_in("completed"))
    return grouped_summary(
        per_user, [], {"arpu": exact.mean_money(F.sum("total_spent"), F.count("user_id"))}
    )


def _sketched_buyers(shop: Shop) -> DataFrame:
    """Per month a sketch of the users with a completed order, and their revenue."""
    done = shop.orders_in("completed")
    return monthly_sketches(done, "created_at", {"users": "user_id"}, {"revenue": exact.money(F.sum("total_amount"))})


@question
def q36_arpu_approx(shop: Shop) -> DataFrame:
    """Revenue per user from monthly sketches, which answer for any months without counting again."""
    total = estimate(_sketched_buyers(shop), ["users"], revenue=exact.money(F.sum("revenue")))
    return total.select(
        F.col("users").alias("users_estimated"), exact.mean_money(F.col("revenue"), F.col("users")).alias("arpu_estimated")
    )


@question
def q36_buyers_by_quarter_approx(shop: Shop) -> DataFrame:
    """Exact buyers per quarter, and whether merged monthly sketches tell them within their bound."""
    start = F.date_trunc("quarter", F.col("month")).cast("timestamp_ntz").alias("quarter")
    merged = estimate(_sketched_buyers(shop), ["users"], [start]).withColumnRenamed("users", "estimated")
    placed = F.date_trunc("quarter", F.col("created_at")).cast("timestamp_ntz").alias("quarter")
    exactly = shop.orders_in("completed").groupBy(placed).agg(F.count_distinct("user_id").alias("users"))
    return exactly.join(merged, "quarter").select(
        "quarter", "users", within_bound(F.col("estimated"), F.col("users")).alias("within_bound")
    )


@question
def q37_orders_by_weekday(shop: Shop) -> DataFrame:
    by_day = grouped_summary(
        shop.orders_in("completed"),
        [times.iso_weekday(F.col("created_at")).alias("number")],
        {
            # Any timestamp of the group names its weekday.
            "weekday": times.weekday_name(F.min("created_at")),
            "order_count": F.count("id"),
            "revenue": _sum_money("total_amount"),
        },
    )
    return by_day.select("weekday", "order_count", "revenue").orderBy(
        desc("order_count"), "weekday"
    )


@question
def q38_repeat_purchase_rate(shop: Shop) -> DataFrame:
    pairs = grouped_summary(
        shop.sales("user_id", status="completed"), ["user_id", "product_id"], {"lines": _rows()}
    )
    return rate_by(pairs, [], F.col("lines") > 1, "pairs", "repeated", "repeat_rate_pct").select(
        "repeat_rate_pct"
    )


@question
def q39_payments_by_status(shop: Shop) -> DataFrame:
    by_status = grouped_summary(
        shop.payments,
        ["status"],
        {"payment_count": F.count("id"), "total_volume": _sum_money("amount")},
    )
    return by_status.orderBy(desc("total_volume"), "status")


@question
def q40_top15_returners(shop: Shop) -> DataFrame:
    order = [desc("order_count"), desc("total_spent")]
    return _top_users(shop, shop.orders_in("returned"), order, 15).select(
        "user_id",
        "email",
        F.col("order_count").alias("returned_orders"),
        F.col("total_spent").alias("return_cost"),
    )


@question
def q41_abandoned_carts(shop: Shop) -> DataFrame:
    order = [desc("created_at")]
    return top_n(_with_email(shop, shop.orders_in("pending")), order, 50, "id").select(
        "email", F.col("id").alias("order_id"), "total_amount", "created_at"
    )


@question
def q42_price_as_of_order(shop: Shop) -> DataFrame:
    lines = shop.sales("created_at", hashed=True).select("order_id", "product_id", "created_at")
    return temporal_lookup(lines, shop.price_history, "product_id", "created_at").select(
        "order_id", "product_id", "created_at", F.col("price").alias("price_at_order")
    )


def _basket_units(shop: Shop) -> DataFrame:
    """Units per order that has lines; one exchange on the order id serves the later join too."""
    return grouped_summary(shop.raw_items, ["order_id"], {"units": _units()})


@question
def q43_top10_bulk_baskets(shop: Shop) -> DataFrame:
    orders = shop.orders_in("completed").select(
        F.col("id").alias("order_id"), "user_id", "total_amount"
    )
    order = [desc("units")]
    baskets = _with_email(shop, _basket_units(shop).join(orders, "order_id"))
    return top_n(baskets, order, 10, "order_id").select(
        "order_id", "email", "units", "total_amount"
    )


@question
def q44_top15_cross_category_orders(shop: Shop) -> DataFrame:
    orders = shop.orders_in("completed").select(F.col("id").alias("order_id"), "total_amount")
    products = shop.named_products.select("product_id", "category_name")
    baskets = grouped_summary(
        shop.raw_items.join(products, "product_id"),
        ["order_id"],
        {
            # The set is bounded by the number of categories, and needs one exchange, not two.
            "category_count": F.size(F.collect_set("category_name")).cast("bigint"),
            "units": _units(),
        },
    ).join(orders, "order_id")
    return top_n(baskets, [desc("category_count"), desc("total_amount")], 15, "order_id").select(
        "order_id", "category_count", "units", "total_amount"
    )


@question
def q45_rfm_scores(shop: Shop) -> DataFrame:
    scores = rfm_scores(
        shop.orders_in("completed"), "user_id", "created_at", "id", "total_amount", ascending=False
    )
    return scores.drop("last_order")


@question
def q46_top3_products_by_units(shop: Shop) -> DataFrame:
    units = _product_sums(shop, "completed").join(shop.catalogue, "product_id")
    top = top_k_per_group(units, ["category_id"], [desc("units")], 3, "product_id", "rank")
    return top.select("category_name", "product_name", "units", "rank")


@question
def q47_monthly_growth_inline(shop: Shop) -> DataFrame:
    return period_growth(
        shop.orders_in("completed"),
        "created_at",
        "total_amount",
        "month",
        "revenue",
        "previous_revenue",
        "growth_pct",
    )


@question
def q48_rolling7_named(shop: Shop) -> DataFrame:
    return (
        _rolling(_daily_units(shop))
        .join(shop.named_products.select("product_id", "product_name"), "product_id")
        .orderBy("product_name", desc("day"), "product_id")
        .select("product_name", times.day_start(F.col("day")).alias("day"), "units", "rolling_avg")
    )


@question
def q49_streaks_row_semantics(shop: Shop) -> DataFrame:
    found = streaks(shop.orders_in("completed"), "user_id", "created_at", dedupe=False)
    return _streak_columns(found, as_timestamp=False)


@question
def q49_streaks_row_semantics_events(shop: Shop) -> DataFrame:
    found = streaks(shop.purchases, "user_id", "ts", dedupe=False)
    return _streak_columns(found, as_timestamp=False)


@question
def q50_median_order_gap(shop: Shop) -> DataFrame:
    return median_gap(shop.orders_in("completed"), "user_id", "created_at", "median_days")


@question
def q50_median_first_gap(shop: Shop) -> DataFrame:
    return median_gap(
        shop.orders_in("completed"), "user_id", "created_at", "median_days", first_gap_only=True
    )
