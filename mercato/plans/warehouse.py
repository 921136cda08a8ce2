"""Star tables, their loads and customer history."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.functions import times
from mercato.plans import Registry
from mercato.sources.schemas import STAR
from mercato.sources.shop import Shop
from mercato.warehouse import star
from mercato.warehouse.history import scd2_apply, scd2_apply_log, scd2_history
from mercato.warehouse.load import PROFILE, Star, full_refresh, incremental_refresh, published, star_of

QUESTIONS = Registry()
question = QUESTIONS.question

# Sign-ups before this day are loaded first; the rest arrives with the change batch.
FIRST_LOAD_BEFORE = "1996-07-01 00:00:00"
CHANGES_EFFECTIVE = "1999-01-01 00:00:00"


@question
def e1_dim_date(shop: Shop) -> DataFrame:
    return star.dim_date(shop.orders)


@question
def e2_dim_product(shop: Shop) -> DataFrame:
    return star.dim_product(shop.products, shop.categories)


@question
def e3_dim_customer_initial(shop: Shop) -> DataFrame:
    return star.dim_customer_initial(shop.users)


@question
def e4_fct_orders(shop: Shop) -> DataFrame:
    return star.fct_orders(shop.orders, star_of(shop).table("dim_customer"))


@question
def e4_fct_orders_as_of(shop: Shop) -> DataFrame:
    return star.fct_orders(shop.orders, e7_scd2_apply(shop), as_of=True)


@question
def e5_fct_order_items(shop: Shop) -> DataFrame:
    return star.fct_order_items(shop.keyed_items(), shop.orders, star_of(shop).table("dim_product"))


@question
def e6_surrogate_key(shop: Shop) -> DataFrame:
    """Dense line numbers over the whole line table."""
    return shop.keyed_items()


@question
def e7_scd2_apply(shop: Shop) -> DataFrame:
    """Early customers, then a batch in which every customer with an order reports a city.

    Customers without an order come unchanged, later sign-ups are new.
    """
    early = shop.users.filter(F.col("created_at") < times.ntz(FIRST_LOAD_BEFORE))
    buyers = shop.orders.select("user_id").distinct()
    city = shop.user_cities.join(buyers, "user_id", "left_semi")
    profile = star.customer_profile(shop.users).drop("city").join(city, "user_id", "left")
    changes = profile.withColumn("city", F.coalesce("city", F.lit(star.UNKNOWN)))
    before = scratch.materialize(star.dim_customer_initial(early), "customers")
    return scd2_apply(before, changes, "user_id", PROFILE, CHANGES_EFFECTIVE, "customer_sk")


@question
def e7_scd2_change_log(shop: Shop) -> DataFrame:
    """Buyers report a city with their first order, write their name in capitals with their last, and repeat it."""
    profile = star.customer_profile(shop.users).drop("city")
    orders = shop.orders.groupBy("user_id").agg(F.min("created_at").alias("first"), F.max("created_at").alias("last"))
    buyers = profile.join(orders, "user_id").join(shop.user_cities, "user_id")
    named, loud = F.col("full_name"), F.upper("full_name")
    steps = F.array(
        F.struct(F.col("first").alias("at"), named.alias("name")),
        F.struct(F.col("last").alias("at"), loud.alias("name")),
        F.struct((F.col("last") + F.expr("INTERVAL 1 DAY")).alias("at"), loud.alias("name")),
    )
    taken = F.when(F.col("first") < F.col("last"), steps).otherwise(F.slice(steps, 1, 1))
    log = buyers.withColumn("step", F.explode(taken)).select(
        "user_id", F.col("step.name").alias("full_name"), "email", "gender", "city", F.col("step.at").alias("at")
    )
    before = star_of(shop).table("dim_customer")
    return scd2_apply_log(before, log, "user_id", PROFILE, "at", "customer_sk")


@question
def e8_scd2_history(shop: Shop) -> DataFrame:
    return scd2_history(e7_scd2_apply(shop), "user_id", 1)


@question
def e9_price_history_backfill(shop: Shop) -> DataFrame:
    return star.price_history_backfill(shop.products)


# What the content of a loaded table is told from.
CONTENT = {
    "dim_date": ("date_id", "full_date", "day_of_week", "month", "quarter", "year"),
    "dim_product": ("product_sk", "product_id", "category_name", "product_name", "current_price"),
    "dim_customer": ("customer_sk", "user_id", "full_name", "email", "city"),
    "fct_orders": ("order_id", "customer_sk", "date_id", "status", "total_amount"),
    "fct_order_items": ("order_item_id", "order_id", "product_sk", "date_id", "quantity", "unit_price", "line_total"),
}


def _content(loaded: Star, name: str) -> DataFrame:
    """Rows of a table and the sum of their hashes."""
    line = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in CONTENT[name]]))
    number = F.conv(F.substring(line, 1, 8), 16, 10).cast("bigint")
    return loaded.table(name).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(number).alias("content")
    ).select(F.lit(name).alias("table_name"), "row_count", "content")


@question
def e10_full_refresh(shop: Shop) -> DataFrame:
    """Rows and content per table after loading twice into one place."""
    root = scratch.new_path(shop.spark, "refresh")
    full_refresh(shop, root)
    full_refresh(shop, root)
    loaded = published(shop.spark, root)
    return reduce(DataFrame.unionByName, [_content(loaded, name) for name in STAR])


class _Earlier(Shop):
    """The shop some time ago: the last orders had not come in, those of one month were not settled."""

    @cached_property
    def orders(self) -> DataFrame:
        latest = self.given("orders").agg(F.max("o_orderkey")).first()[0] or 0
        placed = times.in_month(F.col("created_at"), 1995, 3)
        status = F.when(placed, "pending").otherwise(F.col("status"))
        return super().orders.filter(F.col("id") <= latest - LATE).withColumn("status", status)


# Order numbers that come in late.
LATE = 16


def incremental_loads(shop: Shop, root: str) -> tuple[Star, Star]:
    """A load of the earlier shop, and one of the shop as it is that writes what changed."""
    first = full_refresh(_Earlier(shop.spark, shop.folder), root)
    return first, incremental_refresh(shop, root)


@question
def e10_incremental_refresh(shop: Shop) -> DataFrame:
    """Rows and content per table after changed and late orders: those of a full load."""
    _, loaded = incremental_loads(shop, scratch.new_path(shop.spark, "increment"))
    return reduce(DataFrame.unionByName, [_content(loaded, name) for name in STAR])


class _Moved(Shop):
    """The shop after users of one mail domain have moved to another."""

    @property
    def users(self) -> DataFrame:
        moved = F.replace("email", F.lit("@example.com"), F.lit("@example.net"))
        return super().users.withColumn("email", moved)


def _reloaded(shop: Shop, as_of: bool) -> Star:
    """A load and, after the move, a second one that keeps customer history."""
    root = scratch.new_path(shop.spark, "history")
    full_refresh(shop, root)
    later = _Moved(shop.spark, shop.folder)
    return full_refresh(later, root, keep_history=True, effective=CHANGES_EFFECTIVE, as_of=as_of)


@question
def e10_refresh_keeps_history(shop: Shop) -> DataFrame:
    """The customer dimension after both loads, closed and open versions."""
    return _reloaded(shop, False).table("dim_customer")


@question
def e10_refresh_as_of(shop: Shop) -> DataFrame:
    """Orders by the version of their customer when they were placed."""
    return _reloaded(shop, True).table("fct_orders")
