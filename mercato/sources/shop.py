"""The shop model over a folder of generic Parquet tables.

Each property is a lazy projection of one given table, so Catalyst prunes columns and pushes
filters into the file scan.  No table is cached or broadcast by hand: adaptive execution picks
broadcast joins from measured sizes and falls back to shuffled, skew-split joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato.functions import times
from mercato.session import tune
from mercato.sources.files import listing, read_table
from mercato.sources.schemas import GIVEN

# Sorting by these makes a line number independent of the file order; rows equal in all of
# them are interchangeable.
LINE_ORDER = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
)

EMPTY_CATEGORY = (99, "EMPTY")
# Added users and products have ids above this; nobody orders them.
ADDED = 1_000_000_000
# Parts from this size on are also sold as a second edition.
SECOND_EDITION = 49


def _amount(column: str, width: int = 10) -> Column:
    return F.col(column).cast(f"decimal({width},2)")


class Shop:
    """Users, catalogue, orders and their satellites derived from ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    @cached_property
    def version(self) -> tuple[tuple, ...]:
        """What the folder held when it was first asked for: derived tables are made anew for another."""
        return listing(self.spark, self.folder)

    def given(self, table: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{table}.parquet", GIVEN.get(table))

    @cached_property
    def users(self) -> DataFrame:
        """Customers, and suppliers as users who never order."""

        def signed_up(table: str, prefix: str, shift: int) -> DataFrame:
            key = F.col(f"{prefix}key")
            domain = F.when(key % 10 < 3, "@example.com").otherwise("@example.org")
            signup = F.date_add(F.lit("1995-01-01").cast("date"), (key % 730).cast("int"))
            name = F.lower(F.replace(f"{prefix[0]}_name", F.lit("#"), F.lit(".")))
            return self.given(table).select(
                (key + shift).alias("id"),
                F.concat(name, domain).alias("email"),
                F.lit("x").alias("password_hash"),
                signup.cast("timestamp_ntz").alias("created_at"),
            )

        return signed_up("customer", "c_cust", 0).unionByName(signed_up("supplier", "s_supp", ADDED))

    @cached_property
    def user_cities(self) -> DataFrame:
        """(user_id, city): the nation name stands in for the city."""
        nation = self.given("nation").select("n_nationkey", F.col("n_name").alias("city"))
        customer = self.given("customer").select(
            F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey")
        )
        return customer.join(nation, "n_nationkey").select("user_id", "city")

    @cached_property
    def categories(self) -> DataFrame:
        # One row per part type: the unpartitioned window sees the category list only.
        names = self.given("part").select(F.col("p_type").alias("name")).distinct()
        numbered = names.select(
            F.row_number().over(Window.orderBy("name")).alias("id"), "name"
        )
        number, label = EMPTY_CATEGORY
        empty = self.spark.range(0, 1, 1, numPartitions=1).select(
            (F.col("id") + number).cast("int").alias("id"), F.lit(label).alias("name")
        )
        return numbered.unionByName(empty)

    @cached_property
    def coupons(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.given("nation").select(
            key.alias("id"),
            F.col("n_name").alias("code"),
            (5 + 5 * (key % 10)).cast("int").alias("discount_pct"),
            times.ntz("2030-01-01 00:00:00").alias("valid_until"),
        )

    @cached_property
    def named_products(self) -> DataFrame:
        """Products with their category's (unique) name, which the given table carries: no join.

        Large parts come again as a second edition, which is never sold.
        """
        editions = F.when(
            F.col("p_size") >= SECOND_EDITION, F.array(F.lit(0), F.lit(ADDED))
        ).otherwise(F.array(F.lit(0)))
        return (
            self.given("part")
            .filter(F.col("p_type").isNotNull())
            .withColumn("shift", F.explode(editions))
            .select(
                (F.col("p_partkey") + F.col("shift")).alias("product_id"),
                F.col("p_name").alias("product_name"),
                F.col("p_type").alias("category_name"),
                _amount("p_retailprice").alias("price"),
                (F.col("p_size") % 50).cast("int").alias("stock"),
            )
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """Products joined with their category: one join yields its number and its name."""
        category = self.categories.select(
            F.col("id").alias("category_id"), F.col("name").alias("category_name")
        )
        return self.named_products.join(category, "category_name")

    @cached_property
    def products(self) -> DataFrame:
        return self.catalogue.select(
            F.col("product_id").alias("id"),
            "category_id",
            F.col("product_name").alias("name"),
            "price",
            "stock",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders(F.lit(True))

    def _orders(self, given: Column) -> DataFrame:
        key = F.col("o_orderkey")
        share = key % 100
        status = (
            F.when(share < 2, "returned")
            .when(share < 7, "cancelled")
            .when(share < 10, "pending")
            .otherwise("completed")
        )
        coupon = F.when(key % 4 == 0, F.call_function("div", key, F.lit(4)) % 20)
        clock = F.timestamp_add("SECOND", (key * 7919) % 86_400, F.col("o_orderdate"))
        return self.given("orders").filter(given).select(
            key.alias("id"),
            F.col("o_custkey").alias("user_id"),
            coupon.alias("coupon_id"),
            _amount("o_totalprice").alias("total_amount"),
            status.alias("status"),
            clock.alias("created_at"),
        )

    def orders_from(self, first: str, before: str | None = None) -> DataFrame:
        """Orders placed from one moment on, and before another.

        An order is placed within a day of its date, so the dates' range reaches the file scan.
        """
        day = F.col("o_orderdate").cast("timestamp_ntz")
        dated = day > times.ntz(first) - F.expr("INTERVAL 1 DAY")
        placed = F.col("created_at") >= times.ntz(first)
        if before is not None:
            dated &= day < times.ntz(before)
            placed &= F.col("created_at") < times.ntz(before)
        return self._orders(dated).filter(placed)

    def orders_in(self, status: str) -> DataFrame:
        return self.orders.filter(F.col("status") == status)

    @staticmethod
    def _priced(lines: DataFrame) -> DataFrame:
        """Given lines with the columns of the shop's order lines."""
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        each = F.call_function("div", cents, F.col("l_quantity").cast("bigint"))
        return lines.select(
            "*",
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (each.cast("decimal(10,0)") * F.lit(0.01).cast("decimal(3,2)"))
            .cast("decimal(10,2)")
            .alias("unit_price"),
            # quantity * unit_price as a whole number: sums of it stay in primitive arithmetic.
            (F.col("l_quantity").cast("int") * each).alias("line_cents"),
        )

    @cached_property
    def _lines(self) -> DataFrame:
        """Every given line, whether or not its order is there."""
        return self._priced(self.given("lineitem").select(*LINE_ORDER))

    @cached_property
    def raw_items(self) -> DataFrame:
        """Order lines before orphans are dropped; inner joins with orders drop them anyway."""
        return self._lines.select("order_id", "product_id", "quantity", "unit_price", "line_cents")

    @cached_property
    def order_items(self) -> DataFrame:
        """Order lines whose order exists (no line number: see ``keyed_items``)."""
        known = self.orders.select(F.col("id").alias("order_id"))
        return self.raw_items.join(known, "order_id", "left_semi")

    @property
    def plain_items(self) -> DataFrame:
        """Order lines as declared, without the derived value."""
        return self.order_items.drop("line_cents")

    def keyed_items(self) -> DataFrame:
        """Order lines with their dense number ``id`` in ``LINE_ORDER``.

        Only what orders the lines moves; the rest is derived from it afterwards.
        """
        from mercato.operators.ranks import surrogate_key_in_groups

        lines = self.given("lineitem").select(*LINE_ORDER)
        keyed = surrogate_key_in_groups(lines, LINE_ORDER, self.orders.select("id"), "id")
        return self._priced(keyed).select("id", "order_id", "product_id", "quantity", "unit_price")

    def sales(self, *order_columns: str, status: str | None = None, hashed: bool = False) -> DataFrame:
        """Order lines joined with columns of their order.

        ``hashed`` holds a partition's orders in a hash table; otherwise large lines and orders are both sorted.
        """
        orders = self.orders if status is None else self.orders_in(status)
        known = orders.select(F.col("id").alias("order_id"), *order_columns)
        return self.raw_items.join(known.hint("shuffle_hash") if hashed else known, "order_id")

    @cached_property
    def payments(self) -> DataFrame:
        done = F.col("status") == "completed"
        return self.orders.filter(F.col("status").isin("completed", "returned")).select(
            "id",
            F.col("id").alias("order_id"),
            F.col("total_amount").alias("amount"),
            F.when(done, "success").otherwise("refunded").alias("status"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        return self.orders_in("completed").filter(F.col("id") % 10 != 9).select(
            "id",
            F.col("id").alias("order_id"),
            F.concat(F.lit("TR-"), F.col("id").cast("string")).alias("tracking_number"),
            F.when(F.col("id") % 3 == 0, "shipped").otherwise("delivered").alias("status"),
        )

    @cached_property
    def price_history(self) -> DataFrame:
        """Three versions per product; every seventh product lacks the first."""

        def version(number: int, factor: str, start: str, end: str | None) -> Column:
            return F.struct(
                F.lit(number).alias("number"),
                F.lit(factor).cast("decimal(2,1)").alias("factor"),
                times.ntz(start).alias("valid_from"),
                (F.lit(None).cast("timestamp_ntz") if end is None else times.ntz(end)).alias(
                    "valid_to"
                ),
            )

        versions = F.array(
            version(1, "0.8", "1995-01-01", "1997-01-01"),
            version(2, "0.9", "1997-01-01", "1999-07-01"),
            version(3, "1.0", "1999-07-01", None),
        )
        return (
            self.named_products.select("product_id", "price", F.explode(versions).alias("v"))
            .filter((F.col("v.number") != 1) | (F.col("product_id") % 7 != 0))
            .select(
                "product_id",
                (F.col("price") * F.col("v.factor")).cast("decimal(10,2)").alias("price"),
                F.col("v.valid_from").alias("valid_from"),
                F.col("v.valid_to").alias("valid_to"),
            )
        )

    @cached_property
    def trips(self) -> DataFrame:
        fare = F.col("l_extendedprice").cast("decimal(12,2)")
        toll = _amount("l_tax")
        return self.given("lineitem").select(
            F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("VendorID"),
            F.nullif(F.col("l_linenumber"), F.lit(7)).alias("passenger_count"),
            F.col("l_linenumber").alias("RatecodeID"),
            F.col("l_returnflag").alias("payment_type"),
            _amount("l_quantity").alias("trip_distance"),
            _amount("l_discount").alias("tip_amount"),
            toll.alias("tolls_amount"),
            (F.col("l_suppkey") % 5).cast("decimal(10,2)").alias("extra"),
            fare.alias("fare_amount"),
            (fare + toll).alias("total_amount"),
        )

    @cached_property
    def trip_cents(self) -> DataFrame:
        """Trips with amounts as whole cents: sums of them stay in primitive arithmetic."""

        def whole(column: str) -> Column:
            return F.round(F.col(column) * 100).cast("bigint")

        return self.given("lineitem").select(
            F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("VendorID"),
            F.nullif(F.col("l_linenumber"), F.lit(7)).alias("passenger_count"),
            F.col("l_returnflag").alias("payment_type"),
            whole("l_discount").alias("tip"),
            (F.col("l_suppkey") % 5 * 100).alias("extra"),
            whole("l_extendedprice").alias("fare"),
            (whole("l_extendedprice") + whole("l_tax")).alias("total"),
        )

    @cached_property
    def purchases(self) -> DataFrame:
        """(user_id, ts) of the purchase events."""
        return (
            self.given("events")
            .filter(F.col("event_type") == "purchase")
            .select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
        )


_OPEN: dict[tuple[int, str, str], Shop] = {}


def shop_at(spark: SparkSession, folder: str) -> Shop:
    """The session's shop over ``folder``; its handles are opened anew when a file has changed.

    Opening a table lists its files and resolves its projection, which for a short question costs
    as much as running it; a listing of names, sizes and times is cheap.
    """
    key = (id(spark), spark.sparkContext.applicationId, folder)
    fresh = Shop(spark, folder)
    if key not in _OPEN or _OPEN[key].version != fresh.version:
        _OPEN[key] = fresh
    return _OPEN[key]
