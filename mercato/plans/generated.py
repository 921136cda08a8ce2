"""Generated data keyed by the given tables, and constraint audits."""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import generate, scratch
from mercato.operators import quality
from mercato.plans import Registry
from mercato.sources.files import create_tables, insert_ignore
from mercato.sources.schemas import OPERATIONAL, RULES, STAR
from mercato.sources.shop import Shop
from mercato.warehouse.load import star_of

QUESTIONS = Registry()
question = QUESTIONS.question

NOW = dt.datetime(2025, 12, 31)


def _ids(shop: Shop, table: str, key: str) -> DataFrame:
    """Keys of a given table, counted from one."""
    return shop.given(table).select((F.col(key) + 1).cast("bigint").alias("id"))


def _order_ids(shop: Shop) -> DataFrame:
    return _ids(shop, "orders", "o_orderkey")


def _size(shop: Shop) -> generate.Size:
    return generate.Size(shop.given("customer").count(), shop.given("part").count(), NOW)


@question
def g1_generate_users(shop: Shop) -> DataFrame:
    return generate.users(_ids(shop, "customer", "c_custkey"), NOW)


@question
def g1_generate_products(shop: Shop) -> DataFrame:
    return generate.products(_ids(shop, "part", "p_partkey"))


@question
def g1_generate_coupons(shop: Shop) -> DataFrame:
    return generate.coupons(_ids(shop, "supplier", "s_suppkey"), NOW)


@question
def g1_generate_categories(shop: Shop) -> DataFrame:
    """Generated products per generated category."""
    products = g1_generate_products(shop).groupBy("category_id").agg(
        F.count(F.lit(1)).alias("product_count")
    )
    names = generate.categories(shop.spark).withColumnRenamed("id", "category_id")
    return products.join(F.broadcast(names), "category_id")  # ten rows


@question
def g2_generate_orders(shop: Shop) -> DataFrame:
    return generate.orders(_order_ids(shop), _size(shop))


@question
def g3_generate_order_items(shop: Shop) -> DataFrame:
    return generate.order_items(_order_ids(shop), _size(shop))


@question
def g4_generate_payments(shop: Shop) -> DataFrame:
    return generate.payments(g2_generate_orders(shop))


@question
def g4_generate_shipments(shop: Shop) -> DataFrame:
    return generate.shipments(g2_generate_orders(shop))


@question
def g4_generate_reviews(shop: Shop) -> DataFrame:
    return generate.reviews(_order_ids(shop), _size(shop))


@question
def g4_generate_inventory(shop: Shop) -> DataFrame:
    return generate.inventory_movements(_ids(shop, "part", "p_partkey"), NOW)


@question
def g5_reconcile_order_totals(shop: Shop) -> DataFrame:
    return quality.reconcile_order_totals(shop.orders, shop.raw_items)


@question
def g5_total_mismatches(shop: Shop) -> DataFrame:
    return quality.total_mismatches(shop.orders, shop.raw_items)


@question
def c0_constraint_audit(shop: Shop) -> DataFrame:
    """Every declared rule over the whole model, the star included."""
    shop_tables = {
        "users": shop.users,
        "categories": shop.categories,
        "coupons": shop.coupons,
        "products": shop.products,
        "orders": shop.orders,
        "order_items": shop.keyed_items(),
        "payments": shop.payments,
        "shipments": shop.shipments,
    }
    # Reviews and stock movements exist as generated tables only.
    generated = {
        "users": g1_generate_users(shop),
        "products": g1_generate_products(shop),
        "reviews": g4_generate_reviews(shop),
        "inventory_movements": g4_generate_inventory(shop),
    }
    loaded = star_of(shop)
    star = {name: loaded.table(name) for name in STAR}
    audited = (
        (shop_tables, shop_tables),
        (generated, ("reviews", "inventory_movements")),
        (star, star),
    )
    reports = [quality.audit(tables, {name: RULES[name] for name in names}) for tables, names in audited]
    return reduce(DataFrame.unionByName, reports)


@question
def c1_not_null(shop: Shop) -> DataFrame:
    return quality.check_not_null(shop.trips, "passenger_count")


@question
def c2_unique(shop: Shop) -> DataFrame:
    return quality.check_unique(shop.given("lineitem"), ["l_orderkey", "l_linenumber"])


@question
def c3_foreign_key(shop: Shop) -> DataFrame:
    """Paid orders without a shipment."""
    return quality.check_foreign_key(shop.payments, "order_id", shop.shipments)


@question
def c4_expression(shop: Shop) -> DataFrame:
    return quality.check_expression(shop.trips, "passenger_count <= 5")


@question
def c5_length(shop: Shop) -> DataFrame:
    return quality.check_length(shop.given("part").select("p_partkey", "p_name"), "p_name", 9)


@question
def c6_apply_defaults(shop: Shop) -> DataFrame:
    """Orders that arrive without a status and a moment get what the table declares."""
    incoming = shop.orders.drop("status", "created_at")
    declared = quality.declared_defaults(RULES["orders"], OPERATIONAL["orders"], NOW)
    return quality.apply_defaults(incoming, declared)


@question
def s8_insert_ignore(shop: Shop) -> DataFrame:
    """First event of every user who never returned an order."""
    buyers = shop.orders_in("returned").select("user_id").distinct()
    events = shop.given("events").select("user_id", "event_id", "event_type")
    return insert_ignore(buyers, events, ["user_id"], "event_id")


@question
def s9_create_tables(shop: Shop) -> DataFrame:
    """The star's tables, created with their declared columns and then filled: columns and rows of each."""
    spark, loaded = shop.spark, star_of(shop)
    database = f"star_{uuid.uuid4().hex}"
    create_tables(spark, database, STAR, scratch.new_path(spark, "database"))
    parts = []
    for name in STAR:
        loaded.table(name).write.insertInto(f"{database}.{name}")
        table = spark.table(f"{database}.{name}")
        parts.append(
            table.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(f"{c} {kind}" for c, kind in table.dtypes)).alias("columns"),
                "row_count",
            )
        )
    return reduce(DataFrame.unionByName, parts)
