import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato import scratch
from mercato.operators.temporal import in_bins, temporal_lookup
from mercato.sources.schemas import STAR
from mercato.warehouse import star
from mercato.warehouse.history import scd2_apply, scd2_apply_log, scd2_history
from mercato.warehouse.load import full_refresh, published
from tests.conftest import final_plan, rows

T = dt.datetime
BORN = T(1900, 1, 1)
ATTRIBUTES = ("full_name", "email", "gender", "city")


@pytest.fixture()
def customers(spark):
    data = [
        (1, 1, "ann", "ann@x.org", "Unknown", "Unknown", BORN, None, True),
        (2, 2, "bob", "bob@x.org", "Unknown", "Unknown", BORN, None, True),
    ]
    return spark.createDataFrame(data, STAR["dim_customer"])


def change(spark, *data):
    return spark.createDataFrame(
        list(data), "user_id bigint, full_name string, email string, gender string, city string"
    )


def check_versions(dim):
    """One current row per entity; intervals meet without gap or overlap."""
    assert dim.filter("is_current").groupBy("user_id").count().filter("count != 1").count() == 0
    after = F.lead("valid_from").over(Window.partitionBy("user_id").orderBy("valid_from"))
    assert dim.withColumn("n", after).filter(~F.col("valid_to").eqNullSafe(F.col("n"))).count() == 0
    assert dim.filter(F.col("is_current") != F.col("valid_to").isNull()).count() == 0
    assert dim.groupBy("customer_sk").count().filter("count > 1").count() == 0


def test_change_replay_and_new_customer(spark, customers):
    moved = change(spark, (1, "ann", "new@x.org", "Unknown", "Izmir"), (2, "bob", "bob@x.org", "Unknown", "Unknown"))
    when = T(2024, 5, 1, 12)
    first = scratch.materialize(scd2_apply(customers, moved, "user_id", ATTRIBUTES, when, "customer_sk"), "t")
    check_versions(first)
    history = [(r["email"], r["valid_from"], r["valid_to"]) for r in scd2_history(first, "user_id", 1).collect()]
    assert history == [("ann@x.org", BORN, when), ("new@x.org", when, None)]
    assert first.filter("user_id = 2").count() == 1

    replay = scd2_apply(first, moved, "user_id", ATTRIBUTES, T(2024, 6, 1), "customer_sk")
    assert rows(replay) == rows(first)

    new = change(spark, (7, "eve", "eve@x.org", "Unknown", "Unknown"))
    grown = scd2_apply(first, new, "user_id", ATTRIBUTES, T(2024, 7, 1), "customer_sk")
    check_versions(grown)
    assert grown.filter("user_id = 7").first()["customer_sk"] == 4


def test_change_to_null_is_a_change(spark, customers):
    gone = change(spark, (1, "ann", None, "Unknown", "Unknown"))
    dim = scd2_apply(customers, gone, "user_id", ATTRIBUTES, T(2024, 1, 1), "customer_sk")
    assert dim.filter("user_id = 1").count() == 2


def test_ambiguous_and_late_changes_are_refused(spark, customers):
    one = (1, "ann", "a@x.org", "Unknown", "Unknown")
    with pytest.raises(ValueError, match="several rows"):
        scd2_apply(customers, change(spark, one, one), "user_id", ATTRIBUTES, T(2024, 1, 1), "customer_sk")
    with pytest.raises(ValueError, match="not later"):
        scd2_apply(customers, change(spark, one), "user_id", ATTRIBUTES, BORN, "customer_sk")


def test_lookup_is_half_open(spark):
    a, b = T(2024, 1, 1), T(2024, 2, 1)
    history = spark.createDataFrame(
        [(1, 10, a, b), (1, 20, b, None)], "k int, price int, valid_from timestamp_ntz, valid_to timestamp_ntz"
    )
    second = dt.timedelta(seconds=1)
    facts = spark.createDataFrame(
        [(1, a), (1, b - second), (1, b), (1, a - second), (2, a)], "k int, ts timestamp_ntz"
    )
    found = temporal_lookup(facts, history, "k", "ts").select("ts", "price")
    assert rows(found) == sorted([(a, 10), (b - second, 10), (b, 20)], key=repr)


def test_keys_with_many_versions_meet_few_of_them(spark):
    """10,000 versions of one product, which also has half of the facts; others have few or odd versions."""
    minute = F.expr("INTERVAL 1 MINUTE")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    i = F.col("id")
    many = spark.range(10_000).select(
        F.lit(1).cast("bigint").alias("k"),
        i.alias("price"),
        (start + i.cast("int") * minute).alias("valid_from"),
        F.when(i < 9_999, start + (i + 1).cast("int") * minute).alias("valid_to"),
    )
    few = spark.createDataFrame(
        [(2, -1, T(2024, 1, 1), T(2024, 1, 2)), (2, -2, T(2024, 1, 2), None), (3, -3, T(2025, 1, 1), None), (None, -4, T(2024, 1, 1), None)],
        "k bigint, price bigint, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    # One long version, then twenty short ones with a hole, none open.
    day = F.expr("INTERVAL 1 DAY")
    uneven = spark.range(21).select(
        F.lit(4).cast("bigint").alias("k"),
        (-10 - i).alias("price"),
        F.when(i == 0, start - 900 * day).otherwise(start + i.cast("int") * minute).alias("valid_from"),
        F.when(i == 0, start).otherwise(start + (i + 1).cast("int") * minute).alias("valid_to"),
    )
    history = many.unionByName(few).unionByName(uneven)
    facts = spark.range(8_000).select(
        F.when(i % 2 == 0, 1).when(i % 16 == 1, None).otherwise(i % 5).cast("bigint").alias("k"),
        F.when(i % 101 != 0, start + F.expr("INTERVAL 7 SECOND") * ((i * 263) % 90_000 - 900).cast("int")).alias("ts"),
        i.alias("fact"),
    )
    plain = facts.join(history, "k").filter("ts >= valid_from AND (valid_to IS NULL OR ts < valid_to)")
    found = temporal_lookup(facts, history, "k", "ts")
    assert found.columns == plain.columns
    assert rows(found.select("fact", "price")) == rows(plain.select("fact", "price"))
    placed, versions = in_bins(facts, history, "k", "ts")
    assert versions.count() <= 2 * history.count()
    compared = placed.join(versions, ["k", "_bin"]).count()
    assert compared <= 4 * facts.count()


def test_as_of_fact_takes_the_version_of_its_day(spark, customers):
    when = T(2024, 5, 1)
    moved = change(spark, (1, "ann", "ann@x.org", "Unknown", "Izmir"))
    dim = scratch.materialize(scd2_apply(customers, moved, "user_id", ATTRIBUTES, when, "customer_sk"), "t")
    orders = spark.createDataFrame(
        [(1, 1, T(2024, 4, 30)), (2, 1, when)], "id bigint, user_id bigint, created_at timestamp_ntz"
    ).select("*", F.lit("completed").alias("status"), F.lit(1).cast("decimal(10,2)").alias("total_amount"))
    by_day = star.fct_orders(orders, dim, as_of=True).select("order_id", "customer_sk")
    assert rows(by_day) == [(1, 1), (2, 3)]
    current = star.fct_orders(orders, dim).select("order_id", "customer_sk")
    assert rows(current) == [(1, 3), (2, 3)]


def test_refresh_twice_gives_the_same_star(spark, shop):
    root = scratch.new_path(spark, "star")
    first = full_refresh(shop, root)
    before = {name: rows(first.table(name)) for name in STAR}
    second = full_refresh(shop, root)
    assert published(spark, root).version == second.version != first.version
    for name in STAR:
        assert rows(second.table(name)) == before[name], name
        assert second.table(name).schema.names == STAR[name].names


def test_star_keys_are_complete(spark, shop):
    root = scratch.new_path(spark, "star")
    loaded = full_refresh(shop, root)
    for fact, column, dimension in (
        ("fct_orders", "customer_sk", "dim_customer"),
        ("fct_orders", "date_id", "dim_date"),
        ("fct_order_items", "product_sk", "dim_product"),
        ("fct_order_items", "date_id", "dim_date"),
        ("fct_order_items", "order_id", "fct_orders"),
    ):
        assert loaded.table(fact).join(loaded.table(dimension), column, "left_anti").count() == 0
    assert loaded.table("fct_orders").count() == shop.orders.count()


def test_history_survives_a_refresh_on_request(spark, shop):
    root = scratch.new_path(spark, "star")
    full_refresh(shop, root)

    class Moved(type(shop)):
        @property
        def users(self):
            moved = F.when(F.col("id") == 1, "moved@x.org").otherwise(F.col("email"))
            return shop.users.withColumn("email", moved)

    later = full_refresh(Moved(spark, shop.folder), root, keep_history=True, effective=T(2001, 1, 1))
    dim = later.table("dim_customer")
    check_versions(dim)
    assert dim.count() == shop.users.count() + 1
    assert later.table("fct_orders").count() == shop.orders.count()
    with pytest.raises(ValueError):
        full_refresh(shop, root, keep_history=True)


def test_unfinished_load_stays_invisible(spark, shop):
    root = scratch.new_path(spark, "star")
    done = full_refresh(shop, root)

    class Broken(type(shop)):
        def keyed_items(self):
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        full_refresh(Broken(spark, shop.folder), root)
    assert published(spark, root).version == done.version


def test_padded_names_fill_nine_characters(shop):
    names = star.dim_date(shop.orders, padded_names=True)
    assert names.filter((F.length("day_name") != 9) | (F.length("month_name") != 9)).count() == 0


def test_a_log_of_changes_becomes_versions(spark, customers):
    """Repeats make no version, also of what was open; unseen entities and NULLs come and go."""
    log = spark.createDataFrame(
        [
            (1, "ann", "ann@x.org", "Unknown", "Unknown", T(2024, 1, 1)),
            (1, "ann", "ann@x.org", "Unknown", "Izmir", T(2024, 2, 1)),
            (1, "ann", "ann@x.org", "Unknown", "Izmir", T(2024, 3, 1)),
            (1, "ann", "ann@x.org", "Unknown", None, T(2024, 4, 1)),
            (3, "cem", "c@x.org", "Unknown", "Van", T(2024, 1, 5)),
            (3, "cem", "c@x.org", "Unknown", "Bursa", T(2024, 1, 6)),
        ],
        "user_id bigint, full_name string, email string, gender string, city string, at timestamp_ntz",
    )
    dim = scratch.materialize(scd2_apply_log(customers, log.repartition(3), "user_id", ATTRIBUTES, "at", "customer_sk"), "t")
    found = rows(dim.select("customer_sk", "user_id", "city", "valid_from", "valid_to", "is_current"))
    assert found == sorted(
        [
            (1, 1, "Unknown", BORN, T(2024, 2, 1), False),
            (2, 2, "Unknown", BORN, None, True),
            (3, 1, "Izmir", T(2024, 2, 1), T(2024, 4, 1), False),
            (4, 1, None, T(2024, 4, 1), None, True),
            (5, 3, "Van", T(2024, 1, 5), T(2024, 1, 6), False),
            (6, 3, "Bursa", T(2024, 1, 6), None, True),
        ],
        key=repr,
    )
    check_versions(dim)
    again = scd2_apply_log(dim, log.limit(0), "user_id", ATTRIBUTES, "at", "customer_sk")
    assert rows(again) == rows(dim)
    for bad in (log.unionByName(log.limit(1)), log.withColumn("at", F.lit(BORN)), log.withColumn("at", F.lit(None).cast("timestamp_ntz"))):
        with pytest.raises(ValueError):
            scd2_apply_log(customers, bad, "user_id", ATTRIBUTES, "at", "customer_sk")


def test_a_log_is_joined_once(spark, customers, monkeypatch):
    joins = []
    join = type(customers).join
    monkeypatch.setattr(type(customers), "join", lambda self, *a, **k: joins.append(a) or join(self, *a, **k))
    plain = change(spark, (1, "ann", "ann@x.org", "Unknown", "Izmir"))
    scd2_apply(customers, plain, "user_id", ATTRIBUTES, T(2024, 5, 1), "customer_sk")
    assert [a[2] for a in joins if len(a) > 2] == ["full_outer"]
    # The other one adds the offsets of the numbering: a row per partition.
    assert len(joins) == 2


def test_untouched_months_keep_their_files(spark, shop):
    from mercato.plans.warehouse import LATE, incremental_loads
    from mercato.warehouse.load import FACTS, incremental_refresh, remove_superseded, versions

    root = scratch.new_path(spark, "increment")
    first, second = incremental_loads(shop, root)
    whole = full_refresh(shop, scratch.new_path(spark, "whole"))
    for name in STAR:
        assert rows(second.table(name)) == rows(whole.table(name)), name
    late = shop.orders.filter(F.col("id") > shop.orders.agg(F.max("id")).first()[0] - LATE)
    months = {r[0] for r in late.select(F.date_format("created_at", "yyyyMM").cast("int")).collect()}
    for name, touched in (("fct_orders", months | {199503}), ("fct_order_items", months)):
        written = {r["month_id"] for r in second.manifest if r["table"] == name and r["source"] == second.version}
        assert written == touched and len(touched) < 30
        files = {r[0] for r in second.table(name).select(F.input_file_name()).distinct().collect()}
        assert {f.split("/")[-4] for f in files} == {first.version, second.version}
    assert {r["source"] for r in second.manifest if r["table"] == "dim_customer"} == {first.version}
    # Nothing new: no fact is written, and the tables stay.
    third = incremental_refresh(shop, root)
    assert not [r for r in third.manifest if r["source"] == third.version]
    removed = remove_superseded(spark, root)
    assert any(first.version in path for path in removed) and versions(spark, root)[0] == third.version
    again = published(spark, root)
    for name in STAR:
        assert rows(again.table(name)) == rows(whole.table(name)), name
    gone = {r["month_id"] for r in first.manifest if r["table"] == "fct_orders"} & (months | {199503})
    assert all(any(path.endswith(f"{first.version}/fct_orders/month_id={m}") for path in removed) for m in gone)
    assert remove_superseded(spark, root) == []
    assert set(FACTS) == {"fct_orders", "fct_order_items"}


def test_a_load_moves_its_lines_by_order_once(spark, shop):
    """Numbers, orders and their days meet the lines under one exchange, without one of all lines in ranges."""
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        products = shop.products.select(F.col("id").alias("product_id"), F.col("id").alias("product_sk"))
        found = final_plan(star.fct_order_items(shop.keyed_items(), shop.orders, products))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert "rangepartitioning" not in found
    # Lines and offsets, and the orders: no second exchange of the lines.
    assert found.count("Exchange hashpartitioning(l_orderkey") == 2
    assert found.count("Exchange hashpartitioning(order_id") == 1


def test_a_load_over_another_joins_its_lines_once(spark, shop, monkeypatch):
    """Digests and changed months are told from finished lines, which are stored."""
    from mercato.warehouse.load import incremental_refresh

    root = scratch.new_path(spark, "lines-once")
    before = full_refresh(shop, root)
    stored, materialize = [], scratch.materialize

    def recorded(df, label):
        stored.append(set(df.columns))
        return materialize(df, label)

    monkeypatch.setattr(scratch, "materialize", recorded)
    after = incremental_refresh(shop, root)
    assert set(STAR["fct_order_items"].names) in stored
    assert rows(after.table("fct_order_items")) == rows(before.table("fct_order_items"))


def test_a_load_moves_no_line_value_to_the_months(spark, shop):
    """What is told from other columns of a line is computed behind the exchange, once."""
    from mercato.sources.files import month_id, rebalanced

    products = shop.products.select(F.col("id").alias("product_id"), F.col("id").alias("product_sk"))
    lines = star.fct_order_items(shop.keyed_items(), shop.orders, products).withColumn("month_id", month_id("date_id"))
    moved = rebalanced(lines, "month_id", {"line_total": star.line_total()})
    assert moved.schema == lines.schema
    found = final_plan(moved)
    value = found.index("AS line_total")
    assert found.count("AS line_total") == 1 and value < found.index("Exchange hashpartitioning(month_id")
    assert rows(moved) == rows(lines)


def test_loads_write_facts_without_moving_line_values(spark, shop, monkeypatch):
    from mercato.warehouse.load import incremental_refresh

    frame = type(shop.orders)
    moved, hint = [], frame.hint

    def recorded(self, name, *given):
        moved.extend([set(self.columns)] if name == "rebalance" else [])
        return hint(self, name, *given)

    monkeypatch.setattr(frame, "hint", recorded)
    root = scratch.new_path(spark, "moved")
    first = full_refresh(shop, root)

    class Dearer(type(shop)):
        def keyed_items(self):
            return super().keyed_items().withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(10,2)"))

    second = incremental_refresh(Dearer(spark, shop.folder), root)
    lines = [columns for columns in moved if "quantity" in columns]
    assert len(lines) == 2 and not any("line_total" in columns for columns in lines)
    for loaded in (first, second):
        wrong = loaded.table("fct_order_items").filter(~F.col("line_total").eqNullSafe(star.line_total()))
        assert loaded.table("fct_order_items").count() > 0 and wrong.count() == 0
