import datetime as dt

import pytest
from pyspark.sql import functions as F

from mercato import generate, scratch
from mercato.operators import quality
from mercato.sources.schemas import OPERATIONAL, RULES
from tests.conftest import rows

NOW = dt.datetime(2025, 12, 31)
SIZE = generate.Size(users=400, products=60, now=NOW)
ORDERS = 6_000


@pytest.fixture(scope="module")
def tables(spark):
    ids = generate.keys(spark, ORDERS)
    products = generate.keys(spark, SIZE.products)
    orders = scratch.materialize(generate.orders(ids, SIZE), "orders")
    built = {
        "users": generate.users(generate.keys(spark, SIZE.users), NOW),
        "categories": generate.categories(spark),
        "coupons": generate.coupons(generate.keys(spark, 50), NOW),
        "products": generate.products(products),
        "orders": orders,
        "order_items": generate.order_items(ids, SIZE),
        "payments": generate.payments(orders),
        "shipments": generate.shipments(orders),
        "reviews": generate.reviews(ids, SIZE),
        "inventory_movements": generate.inventory_movements(products, NOW),
    }
    return {name: scratch.materialize(df, name) for name, df in built.items()}


def test_schemas_are_the_declared_ones(tables):
    for name, df in tables.items():
        found = [(f.name, f.dataType) for f in df.schema]
        assert found == [(f.name, f.dataType) for f in OPERATIONAL[name]], name


def test_generated_shop_meets_every_constraint(tables):
    report = quality.audit(tables, {name: RULES[name] for name in tables})
    assert rows(report.filter("violations > 0")) == []


def test_orders_have_one_to_five_different_products(tables):
    per_order = tables["order_items"].groupBy("order_id").agg(
        F.count("id").alias("n"), F.count_distinct("product_id").alias("d")
    )
    assert per_order.filter("n != d").count() == 0
    assert per_order.count() == ORDERS
    sizes = {r["n"]: r["count"] for r in per_order.groupBy("n").count().collect()}
    assert set(sizes) == {1, 2, 3, 4, 5}
    assert all(abs(c / ORDERS - 0.2) < 0.03 for c in sizes.values())


def test_totals_and_prices_agree(tables):
    assert quality.total_mismatches(tables["orders"], tables["order_items"]).count() == 0
    prices = tables["products"].select(F.col("id").alias("product_id"), "price")
    assert tables["order_items"].join(prices, "product_id").filter("price != unit_price").count() == 0


def test_shares(tables):
    orders = tables["orders"]
    share = {r["status"]: r["count"] / ORDERS for r in orders.groupBy("status").count().collect()}
    assert abs(share["returned"] - 0.02) < 0.01 and abs(share["cancelled"] - 0.05) < 0.015
    # Four in ten by design, plus a quarter of the rest by chance.
    summer = orders.filter(F.month("created_at").between(6, 8)).count() / ORDERS
    assert abs(summer - (0.4 + 0.6 * 92 / 365)) < 0.03
    missing = tables["users"].filter(F.col("email").endswith("@missing.com")).count() / SIZE.users
    assert 0.02 < missing < 0.09


def test_popularity_falls_like_pareto(spark):
    from mercato.functions import draws

    size, count = 1_000, 40_000
    drawn = spark.range(count // 16).select(
        F.explode(draws.heavy_tails("t", 0, 16, size, F.col("id"))).alias("place")
    )
    # Share of the top x of all places: 1 - (1 - sqrt(x))^2.
    for x in (0.01, 0.1, 0.5):
        expected = 1 - (1 - x**0.5) ** 2
        found = drawn.filter(F.col("place") < int(x * size)).count() / count
        assert abs(found - expected) < 0.02
    lowest, highest = drawn.agg(F.min("place"), F.max("place")).first()
    assert lowest == 0 and highest < size


def test_same_rows_under_any_partitioning(spark):
    ids = generate.keys(spark, 500)
    assert rows(generate.orders(ids, SIZE)) == rows(generate.orders(ids.repartition(7), SIZE))


def test_few_products_still_fill_every_basket(spark):
    tiny = generate.Size(users=5, products=5, now=NOW)
    items = generate.order_items(generate.keys(spark, 300), tiny)
    counts = items.groupBy("order_id").agg(F.count("id").alias("n"), F.count_distinct("product_id").alias("d"))
    assert counts.filter("n != d").count() == 0
    assert counts.filter("n = 5").count() > 30
    with pytest.raises(ValueError):
        generate.Size(users=5, products=4, now=NOW)


def test_first_review_wins(tables, spark):
    ids = generate.keys(spark, ORDERS)
    every = generate._lines(ids, SIZE, "user_id", "status").select("id", "user_id", "product_id")
    earliest = tables["reviews"].alias("r").join(every.alias("e"), ["user_id", "product_id"])
    assert tables["reviews"].count() > 0 and earliest.count() >= tables["reviews"].count()
