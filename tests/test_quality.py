import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mercato.operators import quality
from mercato.sources.schemas import OPERATIONAL, RULES, STAR
from tests.conftest import final_plan, rows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture()
def clean():
    """A tiny valid shop as plain rows."""
    return {
        "users": [(1, "a@x.org", "h", T0), (2, "b@x.org", "h", T0)],
        "categories": [(1, "books")],
        "coupons": [(1, "TEN", 10, T0)],
        "products": [(1, 1, "atlas", 5, 0)],
        "orders": [(1, 1, None, 5, "completed", T0), (2, 2, 1, 0, "pending", None)],
        "order_items": [(1, 1, 1, 1, 5)],
        "payments": [(1, 1, 5, "success")],
        "shipments": [(1, 1, None, "shipped"), (2, 2, None, "shipped")],
        "reviews": [(1, 1, 1, 5, None)],
        "inventory_movements": [(1, 1, -3, "sale", T0)],
    }


def frames(spark, data):
    from decimal import Decimal

    def fit(name, row):
        kinds = [f.dataType.typeName() for f in OPERATIONAL[name].fields]
        return tuple(Decimal(v) if k == "decimal" and v is not None else v for v, k in zip(row, kinds))

    return {n: spark.createDataFrame([fit(n, r) for r in rs], OPERATIONAL[n]) for n, rs in data.items()}


def violations(spark, data):
    rules = {name: RULES[name] for name in data}
    report = quality.audit(frames(spark, data), rules).filter("violations > 0")
    return {(r["table_name"], r["rule"], r["subject"]): r["violations"] for r in report.collect()}


def test_clean_shop_has_no_violation(spark, clean):
    assert violations(spark, clean) == {}


PLANTED = [
    ("users", (3, None, "h", T0), "not_null", "email"),
    ("users", (4, "a@x.org", "h", T0), "unique", "email"),
    ("users", (5, "x" * 256, "h", T0), "length", "email"),
    ("categories", (2, "y" * 101), "length", "name"),
    ("coupons", (2, "ZERO", 0, T0), "check", "discount_range"),
    ("coupons", (3, "MUCH", 101, T0), "check", "discount_range"),
    ("products", (2, 9, "globe", 5, 1), "foreign_key", "category_id"),
    ("products", (3, 1, "globe", 0, 1), "check", "price_positive"),
    ("products", (4, 1, "globe", 5, -1), "check", "stock_not_negative"),
    ("orders", (3, 9, None, 5, "completed", T0), "foreign_key", "user_id"),
    ("orders", (4, 1, 9, 5, "completed", T0), "foreign_key", "coupon_id"),
    ("orders", (5, 1, None, -1, "completed", T0), "check", "total_not_negative"),
    ("order_items", (2, 1, 1, 0, 5), "check", "quantity_positive"),
    ("order_items", (3, 7, 1, 1, 5), "foreign_key", "order_id"),
    ("payments", (2, 1, 5, "success"), "unique", "order_id"),
    ("shipments", (3, 1, None, "shipped"), "unique", "order_id"),
    ("reviews", (2, 2, 1, 6, None), "check", "rating_range"),
    ("reviews", (3, 1, 1, 4, None), "unique", "user_id+product_id"),
    ("inventory_movements", (2, 1, 3, None, T0), "not_null", "reason"),
]


def test_exactly_the_planted_violations_are_reported(spark, clean):
    expected = Counter()
    for table, row, rule, subject in PLANTED:
        clean[table].append(row)
        expected[table, rule, subject] += 1
    assert violations(spark, clean) == dict(expected)


def test_violating_rows_are_returned(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (1, "toolong"), (2, None)], "k int, t string")
    parent = spark.createDataFrame([(2,)], "id int")
    assert rows(quality.check_not_null(df, "k")) == [(None, "b")]
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows(quality.check_foreign_key(df, "k", parent)) == [(1, 2)]
    assert rows(quality.check_expression(df, "k < 2")) == [(2, None)]
    assert rows(quality.check_length(df, "t", 3)) == [(1, "toolong")]


def test_defaults_fill_absent_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "id int, stock int")
    found = quality.apply_defaults(df, {"stock": F.lit(0), "status": F.lit("pending")})
    assert rows(found) == [(1, None, "pending")]


@pytest.mark.parametrize("table, absent", [("users", 1), ("products", 1), ("orders", 2), ("inventory_movements", 1)])
def test_declared_defaults_have_the_declared_types(spark, table, absent):
    declared = quality.declared_defaults(RULES[table], OPERATIONAL[table], T0)
    assert len(declared) == absent
    bare = spark.createDataFrame([], OPERATIONAL[table]).drop(*declared)
    filled = quality.apply_defaults(bare, declared)
    assert {f.name: f.dataType for f in filled.schema} == {f.name: f.dataType for f in OPERATIONAL[table]}
    row = spark.range(1).select(*[v.alias(n) for n, v in declared.items()]).first().asDict()
    assert row.get("created_at", T0) == T0 and row.get("status", "pending") == "pending"


@pytest.fixture()
def clean_star():
    day = dt.date(2024, 1, 1)
    return {
        "dim_date": [(20240101, day, 1, "Monday", 1, "January", 1, 2024, False)],
        "dim_product": [(1, 7, "books", "atlas", 5)],
        "dim_customer": [(1, 3, "a", "a@x.org", "Unknown", "Unknown", T0, None, True)],
        "fct_orders": [(1, 1, 20240101, "completed", 5, 0), (2, None, None, None, None, None)],
        "fct_order_items": [(1, 1, 1, 20240101, 1, 5, 5), (2, None, None, None, None, None, None)],
    }


def star_violations(spark, data):
    from decimal import Decimal

    def fit(name, row):
        kinds = [f.dataType.typeName() for f in STAR[name].fields]
        return tuple(Decimal(v) if k == "decimal" and v is not None else v for v, k in zip(row, kinds))

    tables = {n: spark.createDataFrame([fit(n, r) for r in rs], STAR[n]) for n, rs in data.items()}
    report = quality.audit(tables, {name: RULES[name] for name in STAR})
    return {(r["table_name"], r["rule"], r["subject"]): r["violations"] for r in report.filter("violations > 0").collect()}


STAR_PLANTED = [
    ("dim_date", (20240102, None, 2, "x" * 11, 1, "January", 1, 2024, False), {("not_null", "full_date"), ("length", "day_name")}),
    ("dim_product", (1, 8, "books", "globe", 5), {("unique", "product_sk")}),
    ("dim_customer", (2, 3, "a", "a@x.org", "y" * 11, "c", T0, None, None), {("not_null", "is_current"), ("length", "gender")}),
    ("fct_orders", (3, 9, 20250101, "completed", 5, 0), {("foreign_key", "customer_sk"), ("foreign_key", "date_id")}),
    ("fct_order_items", (3, 9, 9, 20250101, 1, 5, 5), {("foreign_key", c) for c in ("order_id", "product_sk", "date_id")}),
    ("fct_order_items", (1, 1, 1, 20240101, 1, 5, 5), {("unique", "order_item_id")}),
]


def test_star_rules_report_the_planted_violations(spark, clean_star):
    assert star_violations(spark, clean_star) == {}
    expected = Counter()
    for table, row, broken in STAR_PLANTED:
        clean_star[table].append(row)
        expected.update((table, *rule) for rule in broken)
    assert star_violations(spark, clean_star) == dict(expected)


def test_references_of_a_table_come_from_one_scan(spark, tmp_path):
    """Three parents, one scan of the facts, and a frequent value leaves a task as one pair."""
    path = f"{tmp_path}/facts"
    i = F.col("id")
    spark.range(3_000).select(F.when(i % 3 == 0, 7).otherwise(i % 50).alias("a"), (i % 5).alias("b"), i.alias("c")).write.parquet(path)
    facts = spark.read.parquet(path)
    parents = {
        "a": (spark.range(40), "id"),
        "b": (spark.range(5), "id"),
        "c": (spark.range(2_990).withColumnRenamed("id", "k"), "k"),
    }
    found = quality.count_orphans(facts, parents)
    assert rows(found) == [(facts.filter("a >= 40").count(), 0, 10)]
    plan = final_plan(found)
    assert plan.count("Scan parquet") == 1


def test_totals_reconcile(spark):
    data = {
        "orders": [(1, 1, None, 9, "completed", T0), (2, 1, None, 3, "completed", T0), (3, 1, None, 0, "pending", T0)],
        "order_items": [(1, 1, 1, 2, 2), (2, 1, 1, 1, 5), (3, 2, 1, 1, 4)],
    }
    f = frames(spark, data)
    bad = quality.total_mismatches(f["orders"], f["order_items"])
    assert [r["id"] for r in bad.collect()] == [2]
    fixed = quality.reconcile_order_totals(f["orders"], f["order_items"])
    assert fixed.columns == f["orders"].columns
    assert quality.total_mismatches(fixed, f["order_items"]).count() == 0
