"""Synthetic shop data.

Every table is a projection of a key frame (a column ``id`` 1..n).  Lines, totals and prices follow
from the order id alone, so no table needs a join or a shuffle, except reviews, which keep one row
per user and product.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.functions import draws, times
from mercato.sources.files import first_per_key

# Vocabulary, shares and ranges of the generated shop.
CATEGORIES = (
    "Elektronik",
    "Giyim",
    "Ev ve Yaşam",
    "Kitap",
    "Kozmetik",
    "Spor",
    "Oyuncak",
    "Otomotiv",
    "Gıda",
    "Pet Shop",
)
MISSING_EMAIL_SHARE = 0.05
SUMMER_SHARE = 0.40
RETURNED_SHARE = 0.02
CANCELLED_SHARE = 0.05
REVIEW_SHARE = 0.10
DISCOUNT = (5, 50)
PRICE_CENTS = (1_000, 500_000)
STOCK = (10, 1_000)
LINES = (1, 5)
QUANTITY = (1, 3)
RATING = (1, 5)
INITIAL_STOCK = (100, 1_000)
INITIAL_REASON = "Initial Stock Load"

DAY = 86_400
FIRST_PICKS, MORE_PICKS = 16, 64


@dataclass(frozen=True)
class Size:
    """How many users and products orders choose from, and the moment the data ends."""

    users: int
    products: int
    now: dt.datetime

    def __post_init__(self) -> None:
        if self.products < LINES[1]:
            raise ValueError(f"an order needs up to {LINES[1]} different products")


def keys(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1..n."""
    return spark.range(1, n + 1)


def _draw(name: str) -> Column:
    return draws.uniform(name, F.col("id"))


def categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(CATEGORIES, 1)), "id int, name string")


def users(ids: DataFrame, now: dt.datetime) -> DataFrame:
    """Sign-ups over two years; one in twenty has only a placeholder address."""
    number = F.col("id").cast("string")
    start = times.ntz(now - dt.timedelta(days=730))
    return ids.select(
        "id",
        F.when(
            _draw("missing") < MISSING_EMAIL_SHARE,
            F.concat(F.lit("user_"), number, F.lit("@missing.com")),
        )
        .otherwise(F.concat(F.lit("user"), number, F.lit("@example.com")))
        .alias("email"),
        F.sha2(F.concat(F.lit("password"), number), 256).alias("password_hash"),
        draws.moment(_draw("signup"), start, 730 * DAY).alias("created_at"),
    )


def coupons(ids: DataFrame, now: dt.datetime) -> DataFrame:
    number = F.col("id").cast("string")
    return ids.select(
        F.col("id").cast("int").alias("id"),
        F.concat(F.lit("DISCOUNT-"), F.lpad(number, F.greatest(F.length(number), F.lit(4)), F.lit("0"))).alias("code"),
        draws.whole(_draw("discount"), *DISCOUNT).cast("int").alias("discount_pct"),
        draws.moment(_draw("expiry"), times.ntz(now), 365 * DAY).alias("valid_until"),
    )


def _price(product_id: Column) -> Column:
    return draws.amount(draws.uniform("price", product_id), *PRICE_CENTS)


def products(ids: DataFrame) -> DataFrame:
    return ids.select(
        "id",
        draws.whole(_draw("category"), 1, len(CATEGORIES)).cast("int").alias("category_id"),
        F.concat(F.lit("product-"), F.col("id").cast("string")).alias("name"),
        _price(F.col("id")).alias("price"),
        draws.whole(_draw("stock"), *STOCK).cast("int").alias("stock"),
    )


def _picks(first: int, count: int, size: int) -> Column:
    """``count`` product positions drawn by popularity, repeats included."""
    return draws.heavy_tails("pick", first, count, size, F.col("id"))


def _baskets(ids: DataFrame, size: Size) -> DataFrame:
    """One row per order: user, moment, status and its lines as an array.

    Products are drawn without repetition: of 16 draws the first n different ones are kept; the
    rare order that falls short draws 64 more, and the most popular products fill what is left.
    """
    now = size.now
    summer = dt.datetime(now.year, 6, 1)
    summer_days = (dt.datetime(now.year, 8, 31) - summer).days
    year_ago = now - dt.timedelta(days=365)
    when = draws.uniforms("when", F.col("id"))
    state = draws.uniforms("order", F.col("id"))
    ordered = ids.select(
        "id",
        (F.floor(state[0] * F.lit(float(size.users))) + 1).alias("user_id"),
        F.when(state[1] < RETURNED_SHARE, "returned")
        .when(state[1] < RETURNED_SHARE + CANCELLED_SHARE, "cancelled")
        .otherwise("completed")
        .alias("status"),
        F.when(
            when[0] < SUMMER_SHARE,
            draws.moment(when[1], times.ntz(summer), summer_days * DAY),
        )
        .otherwise(draws.moment(when[1], times.ntz(year_ago), 365 * DAY))
        .alias("created_at"),
        draws.whole(state[2], *LINES).cast("int").alias("_lines"),
        F.array_distinct(_picks(0, FIRST_PICKS, size.products)).alias("_picked"),
    )
    more = F.concat(
        F.col("_picked"),
        _picks(FIRST_PICKS, MORE_PICKS, size.products),
        F.array(*[F.lit(i).cast("bigint") for i in range(LINES[1])]),
    )
    enough = F.when(F.size("_picked") >= F.col("_lines"), F.col("_picked")).otherwise(
        F.array_distinct(more)
    )
    chosen = ordered.withColumn("_chosen", F.slice(enough, 1, F.col("_lines")))

    def line(place: Column, position: Column) -> Column:
        salt = F.concat(F.lit("quantity"), position.cast("string"))
        return F.struct(
            position.alias("position"),
            (place + 1).alias("product_id"),
            draws.whole(draws.uniform(salt, F.col("id")), *QUANTITY).cast("int").alias("quantity"),
            _price(place + 1).alias("unit_price"),
        )

    lines = F.transform("_chosen", line)
    return chosen.select("id", "user_id", "status", "created_at", lines.alias("lines"))


def _total(lines: Column) -> Column:
    zero = F.lit(0).cast("decimal(10,2)")
    return F.aggregate(
        lines,
        zero,
        lambda total, line: (total + line["unit_price"] * line["quantity"]).cast("decimal(10,2)"),
    )


def orders(ids: DataFrame, size: Size) -> DataFrame:
    """Orders whose total is the sum of their lines; four in ten fall into the summer."""
    return _baskets(ids, size).select(
        "id",
        "user_id",
        F.lit(None).cast("bigint").alias("coupon_id"),
        _total(F.col("lines")).alias("total_amount"),
        "status",
        "created_at",
    )


def _lines(ids: DataFrame, size: Size, *extra: str) -> DataFrame:
    # No basket is empty; the outer form spares a test that would compute the lines twice.
    exploded = _baskets(ids, size).select(
        F.col("id").alias("order_id"), *extra, F.explode_outer("lines").alias("line")
    )
    # At most five lines per order leave room for an id without counting over the table.
    return exploded.select(
        (F.col("order_id") * LINES[1] + F.col("line.position")).alias("id"),
        "order_id",
        *extra,
        "line.product_id",
        "line.quantity",
        "line.unit_price",
    )


def order_items(ids: DataFrame, size: Size) -> DataFrame:
    """One to five different products per order, popular ones far more often."""
    return _lines(ids, size)


def payments(orders_: DataFrame) -> DataFrame:
    """One payment for every order that was not cancelled."""
    done = F.col("status") == "completed"
    return orders_.filter(F.col("status") != "cancelled").select(
        "id",
        F.col("id").alias("order_id"),
        F.col("total_amount").alias("amount"),
        F.when(done, "success").otherwise("refunded").alias("status"),
    )


def shipments(orders_: DataFrame) -> DataFrame:
    """One shipment for every completed order; two in three are delivered."""
    number = F.col("id").cast("string")
    padded = F.lpad(number, F.greatest(F.length(number), F.lit(9)), F.lit("0"))
    return orders_.filter(F.col("status") == "completed").select(
        "id",
        F.col("id").alias("order_id"),
        F.concat(F.lit("TR-"), padded).alias("tracking_number"),
        F.when(draws.whole(_draw("shipment"), 0, 2) == 0, "shipped")
        .otherwise("delivered")
        .alias("status"),
    )


def reviews(ids: DataFrame, size: Size) -> DataFrame:
    """Reviews of every product in a tenth of the completed orders, the first per user and product."""
    reviewed = _lines(ids, size, "user_id", "status").filter(
        (F.col("status") == "completed")
        & (draws.uniform("reviewed", F.col("order_id")) < REVIEW_SHARE)
    )
    written = reviewed.select(
        "id",
        "user_id",
        "product_id",
        draws.whole(_draw("rating"), *RATING).cast("int").alias("rating"),
        F.concat(F.lit("review "), F.col("id").cast("string")).alias("comment"),
    )
    return first_per_key(written, ["user_id", "product_id"], "id")


def inventory_movements(product_ids: DataFrame, now: dt.datetime) -> DataFrame:
    """One initial stock movement per product."""
    return product_ids.select(
        "id",
        F.col("id").alias("product_id"),
        draws.whole(_draw("movement"), *INITIAL_STOCK).cast("int").alias("quantity_changed"),
        F.lit(INITIAL_REASON).alias("reason"),
        times.ntz(now).alias("created_at"),
    )
