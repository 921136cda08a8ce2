"""Declared schemas and constraints of the operational tables and the star."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

BIGINT, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
MONEY, MOMENT, DAY, FLAG = T.DecimalType(10, 2), T.TimestampNTZType(), T.DateType(), T.BooleanType()
REAL, VECTOR = T.DoubleType(), T.ArrayType(T.FloatType())


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The generic tables a folder holds; declaring them spares a footer read per scan.
GIVEN: dict[str, T.StructType] = {
    "nation": _table(
        n_nationkey=INT,
        n_name=TEXT,
        n_regionkey=INT,
    ),
    "customer": _table(
        c_custkey=BIGINT,
        c_name=TEXT,
        c_nationkey=INT,
        c_acctbal=REAL,
        c_mktsegment=TEXT,
    ),
    "supplier": _table(
        s_suppkey=BIGINT,
        s_name=TEXT,
        s_nationkey=INT,
        s_acctbal=REAL,
    ),
    "part": _table(
        p_partkey=BIGINT,
        p_name=TEXT,
        p_brand=TEXT,
        p_type=TEXT,
        p_size=INT,
        p_retailprice=REAL,
    ),
    "orders": _table(
        o_orderkey=BIGINT,
        o_custkey=BIGINT,
        o_orderstatus=TEXT,
        o_totalprice=REAL,
        o_orderdate=MOMENT,
        o_orderpriority=TEXT,
    ),
    "lineitem": _table(
        l_orderkey=BIGINT,
        l_partkey=BIGINT,
        l_suppkey=BIGINT,
        l_linenumber=INT,
        l_quantity=REAL,
        l_extendedprice=REAL,
        l_discount=REAL,
        l_tax=REAL,
        l_returnflag=TEXT,
        l_linestatus=TEXT,
        l_shipdate=MOMENT,
    ),
    "events": _table(
        event_id=BIGINT,
        ts=MOMENT,
        user_id=BIGINT,
        event_type=TEXT,
        value=REAL,
        props=TEXT,
    ),
    "embeddings": _table(
        vec_id=BIGINT,
        embedding=VECTOR,
        label=INT,
    ),
}

OPERATIONAL: dict[str, T.StructType] = {
    "users": _table(
        id=BIGINT,
        email=TEXT,
        password_hash=TEXT,
        created_at=MOMENT,
    ),
    "categories": _table(
        id=INT,
        name=TEXT,
    ),
    "coupons": _table(
        id=INT,
        code=TEXT,
        discount_pct=INT,
        valid_until=MOMENT,
    ),
    "products": _table(
        id=BIGINT,
        category_id=INT,
        name=TEXT,
        price=MONEY,
        stock=INT,
    ),
    "orders": _table(
        id=BIGINT,
        user_id=BIGINT,
        coupon_id=BIGINT,
        total_amount=MONEY,
        status=TEXT,
        created_at=MOMENT,
    ),
    "order_items": _table(
        id=BIGINT,
        order_id=BIGINT,
        product_id=BIGINT,
        quantity=INT,
        unit_price=MONEY,
    ),
    "payments": _table(
        id=BIGINT,
        order_id=BIGINT,
        amount=MONEY,
        status=TEXT,
    ),
    "shipments": _table(
        id=BIGINT,
        order_id=BIGINT,
        tracking_number=TEXT,
        status=TEXT,
    ),
    "reviews": _table(
        id=BIGINT,
        user_id=BIGINT,
        product_id=BIGINT,
        rating=INT,
        comment=TEXT,
    ),
    "inventory_movements": _table(
        id=BIGINT,
        product_id=BIGINT,
        quantity_changed=INT,
        reason=TEXT,
        created_at=MOMENT,
    ),
    "product_price_history": _table(
        product_id=BIGINT,
        price=MONEY,
        valid_from=MOMENT,
        valid_to=MOMENT,
    ),
}

STAR: dict[str, T.StructType] = {
    "dim_date": _table(
        date_id=INT,
        full_date=DAY,
        day_of_week=INT,
        day_name=TEXT,
        month=INT,
        month_name=TEXT,
        quarter=INT,
        year=INT,
        is_weekend=FLAG,
    ),
    "dim_product": _table(
        product_sk=BIGINT,
        product_id=BIGINT,
        category_name=TEXT,
        product_name=TEXT,
        current_price=MONEY,
    ),
    "dim_customer": _table(
        customer_sk=BIGINT,
        user_id=BIGINT,
        full_name=TEXT,
        email=TEXT,
        gender=TEXT,
        city=TEXT,
        valid_from=MOMENT,
        valid_to=MOMENT,
        is_current=FLAG,
    ),
    "fct_orders": _table(
        order_id=BIGINT,
        customer_sk=BIGINT,
        date_id=INT,
        status=TEXT,
        total_amount=MONEY,
        shipping_cost=MONEY,
    ),
    "fct_order_items": _table(
        order_item_id=BIGINT,
        order_id=BIGINT,
        product_sk=BIGINT,
        date_id=INT,
        quantity=INT,
        unit_price=MONEY,
        line_total=MONEY,
    ),
}


# Stands for the moment a row arrives, which the caller tells.
NOW = "now"


@dataclass(frozen=True)
class Rules:
    """What a table promises about its rows."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: dict[str, str] = field(default_factory=dict)  # column -> parent table (its id), or table.column
    checks: dict[str, str] = field(default_factory=dict)  # rule name -> condition; NULL passes
    lengths: dict[str, int] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)  # column -> SQL literal, or NOW


# The constraints the data model declares.
RULES: dict[str, Rules] = {
    "users": Rules(
        not_null=("id", "email", "password_hash"),
        unique=(("id",), ("email",)),
        lengths={"email": 255, "password_hash": 255},
        defaults={"created_at": NOW},
    ),
    "categories": Rules(
        not_null=("id", "name"), unique=(("id",), ("name",)), lengths={"name": 100}
    ),
    "coupons": Rules(
        not_null=("id", "code", "valid_until"),
        unique=(("id",), ("code",)),
        checks={"discount_range": "discount_pct > 0 AND discount_pct <= 100"},
        lengths={"code": 50},
    ),
    "products": Rules(
        not_null=("id", "category_id", "name", "price"),
        unique=(("id",),),
        foreign={"category_id": "categories"},
        checks={"price_positive": "price > 0", "stock_not_negative": "stock >= 0"},
        lengths={"name": 255},
        defaults={"stock": "0"},
    ),
    "orders": Rules(
        not_null=("id", "user_id", "total_amount", "status"),
        unique=(("id",),),
        foreign={"user_id": "users", "coupon_id": "coupons"},
        checks={"total_not_negative": "total_amount >= 0"},
        lengths={"status": 50},
        defaults={"status": "'pending'", "created_at": NOW},
    ),
    "order_items": Rules(
        not_null=("id", "order_id", "product_id", "quantity", "unit_price"),
        unique=(("id",),),
        foreign={"order_id": "orders", "product_id": "products"},
        checks={"quantity_positive": "quantity > 0", "unit_price_positive": "unit_price > 0"},
    ),
    "payments": Rules(
        not_null=("id", "order_id", "amount", "status"),
        unique=(("id",), ("order_id",)),
        foreign={"order_id": "orders"},
        checks={"amount_positive": "amount > 0"},
        lengths={"status": 50},
    ),
    "shipments": Rules(
        not_null=("id", "order_id", "status"),
        unique=(("id",), ("order_id",), ("tracking_number",)),
        foreign={"order_id": "orders"},
        lengths={"tracking_number": 100, "status": 50},
    ),
    "reviews": Rules(
        not_null=("id", "user_id", "product_id", "rating"),
        unique=(("id",), ("user_id", "product_id")),
        foreign={"user_id": "users", "product_id": "products"},
        checks={"rating_range": "rating >= 1 AND rating <= 5"},
    ),
    "inventory_movements": Rules(
        not_null=("id", "product_id", "quantity_changed", "reason"),
        unique=(("id",),),
        foreign={"product_id": "products"},
        lengths={"reason": 255},
        defaults={"created_at": NOW},
    ),
    "product_price_history": Rules(),
    "dim_date": Rules(
        not_null=("date_id", "full_date"),
        unique=(("date_id",),),
        lengths={"day_name": 10, "month_name": 10},
    ),
    "dim_product": Rules(
        not_null=("product_sk", "product_id"),
        unique=(("product_sk",),),
        lengths={"category_name": 100, "product_name": 255},
    ),
    "dim_customer": Rules(
        not_null=("customer_sk", "user_id", "valid_from", "is_current"),
        unique=(("customer_sk",),),
        lengths={"full_name": 255, "email": 255, "gender": 10, "city": 100},
        defaults={"is_current": "true"},
    ),
    "fct_orders": Rules(
        not_null=("order_id",),
        unique=(("order_id",),),
        foreign={"customer_sk": "dim_customer.customer_sk", "date_id": "dim_date.date_id"},
        lengths={"status": 50},
    ),
    "fct_order_items": Rules(
        not_null=("order_item_id",),
        unique=(("order_item_id",),),
        foreign={
            "order_id": "fct_orders.order_id",
            "product_sk": "dim_product.product_sk",
            "date_id": "dim_date.date_id",
        },
    ),
}
