import pytest
from pyspark.sql import functions as F

from mercato import scratch
from mercato.sources import files
from mercato.sources.schemas import OPERATIONAL, STAR
from tests.conftest import SF, copied, final_plan, rows


def test_a_changed_folder_is_seen(spark, tmp_path):
    """Questions asked through the session's shop see files that arrived since."""
    from mercato.sources.shop import shop_at

    folder = copied(f"{tmp_path}/shop", "customer")
    given = spark.read.parquet(f"{SF}/customer.parquet")
    given.write.parquet(f"{folder}/customer.parquet")
    before = shop_at(spark, folder)
    users = before.users.count()
    assert shop_at(spark, folder) is before
    more = given.withColumn("c_custkey", F.col("c_custkey") + 10_000)
    more.write.mode("append").parquet(f"{folder}/customer.parquet")
    assert shop_at(spark, folder) is not before
    assert shop_at(spark, folder).users.count() == users + more.count()


def test_a_month_reads_its_folder_only(spark, shop):
    path = scratch.new_path(spark, "months")
    files.write_by_month(shop.orders, "created_at", path)
    table = files.read_by_month(spark, path, shop.orders.schema)
    july = files.one_month(table, "created_at", 2000, 7)
    scan = final_plan(july)
    assert "PartitionFilters: [isnotnull(month_id" in scan
    expected = shop.orders.filter((F.year("created_at") == 2000) & (F.month("created_at") == 7))
    assert rows(july) == rows(expected)


def may_match(paths, conditions):
    """Files whose statistics leave room for rows that meet all (column, low, high), ends included."""
    import pyarrow.parquet as pq

    found = 0
    for path in paths:
        file = pq.ParquetFile(path)
        names = file.schema_arrow.names
        for group in range(file.metadata.num_row_groups):
            group_ = file.metadata.row_group(group)
            stats = {c: group_.column(names.index(c)).statistics for c, _, _ in conditions}
            found += all(stats[c].max >= low and stats[c].min <= high for c, low, high in conditions)
    return found


def test_one_layout_skips_files_for_ranges_of_every_column(spark, shop):
    import datetime as dt
    import glob
    from decimal import Decimal

    bounds = files.curve_bounds(shop.orders, ["status", "created_at", "total_amount"])
    path = scratch.new_path(spark, "curve")
    files.write_on_curve(shop.orders, bounds, path, 64)
    table = files.read_table(spark, path, shop.orders.schema)
    assert rows(table) == rows(shop.orders)
    paths = glob.glob(f"{path.removeprefix('file:')}/*.parquet")
    assert len(paths) > 50
    moments = dt.datetime(2000, 7, 1), dt.datetime(2000, 8, 1)
    late = dt.datetime(2000, 1, 1), dt.datetime(9999, 1, 1)
    top = Decimal(sorted(r[0] for r in shop.orders.select("total_amount").collect())[-20])
    for conditions, share in (
        ([("created_at", *moments)], 0.45),
        ([("total_amount", top, Decimal(10**7))], 0.45),
        ([("status", "cancelled", "cancelled"), ("created_at", *late)], 0.45),
    ):
        assert 0 < may_match(paths, conditions) <= share * len(paths), conditions


def test_a_layout_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), ("b", 7)], "t string, n int")
    for part in (df, df.limit(0), df.filter("n IS NULL")):
        path = scratch.new_path(spark, "curve")
        files.write_on_curve(part, files.curve_bounds(part, ["t", "n"]), path, 4)
        assert rows(files.read_table(spark, path, df.schema)) == rows(part)


def test_clustered_files_skip(spark, shop):
    path = scratch.new_path(spark, "clustered")
    files.write_clustered(shop.order_items, ["order_id"], path, bloom="order_id")
    table = files.read_table(spark, path, shop.order_items.schema)
    assert rows(table) == rows(shop.order_items)
    assert "EqualTo(order_id,750)" in final_plan(table.filter("order_id = 750"))
    ranges = table.groupBy(F.input_file_name()).agg(F.min("order_id").alias("a"), F.max("order_id").alias("b"))
    bounds = sorted((r["a"], r["b"]) for r in ranges.collect())
    assert all(low[1] < high[0] for low, high in zip(bounds, bounds[1:]))


def test_bucketed_tables_join_and_group_without_exchange(spark, shop):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files.write_bucketed(shop.orders, "b_orders", "id", 4, scratch.new_path(spark, "b"))
        files.write_bucketed(shop.order_items, "b_items", "order_id", 4, scratch.new_path(spark, "b"))
        orders = spark.table("b_orders").withColumnRenamed("id", "order_id")
        joined = spark.table("b_items").join(orders, "order_id").groupBy("order_id").agg(F.sum("quantity"))
        assert "Exchange" not in final_plan(joined)
        assert joined.count() == shop.order_items.select("order_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_insert_ignore_keeps_keys_unique(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, 1, "x"), (2, 5, "late"), (2, 3, "early"), (3, 9, None), (None, 1, "n"), (None, 2, "n")], "k int, at int, v string")
    added = files.insert_ignore(target, new, ["k"], "at")
    assert rows(added) == [(2, 3, "early"), (3, 9, None), (None, 1, "n"), (None, 2, "n")]


def test_tables_are_created_once_and_accept_rows(spark, tmp_path):
    files.create_tables(spark, "dwh", STAR, tmp_path.as_uri())
    files.create_tables(spark, "dwh", STAR, tmp_path.as_uri())
    row = spark.createDataFrame([(1, 2, "c", "p", None)], STAR["dim_product"])
    row.write.insertInto("dwh.dim_product")
    assert spark.table("dwh.dim_product").count() == 1
    assert spark.table("dwh.fct_orders").schema.names == STAR["fct_orders"].names


def test_declared_schemas_fit_the_model(shop):
    views = {
        "users": shop.users,
        "categories": shop.categories,
        "coupons": shop.coupons,
        "products": shop.products,
        "orders": shop.orders,
        "order_items": shop.keyed_items(),
        "payments": shop.payments,
        "shipments": shop.shipments,
        "product_price_history": shop.price_history,
    }
    for name, df in views.items():
        declared = [(f.name, f.dataType) for f in OPERATIONAL[name]]
        assert [(f.name, f.dataType) for f in df.schema] == declared, name


def test_scratch_follows_the_session(spark, monkeypatch):
    assert scratch.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    stored = scratch.materialize(spark.range(3), "t")
    assert all(f.startswith(spark.conf.get("spark.checkpoint.dir")) for f in stored.inputFiles())


def test_a_cluster_without_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch.shared_folder(Session())


@pytest.mark.parametrize("number", [0, 1, 2, 3, 7, 8, 100, 255])
def test_places_on_the_curve_count_the_bounds_below(spark, number):
    df = spark.range(-3, 530).select(F.when(F.col("id") % 50 != 7, F.col("id")).alias("v"))
    found = df.select("v", files.curve(df, {"v": [2 * i for i in range(number)]}).alias("place"))
    for v, place in found.collect():
        assert place == (0 if v is None else sum(2 * i <= v for i in range(number)))


def test_a_place_meets_few_bounds(spark):
    """A row is not compared with each of 255 bounds."""
    df = spark.range(1).select(F.col("id").alias("v"))
    plan = files.curve(df, {"v": list(range(255))})
    assert "filter(" not in plan._jc.toString() and "aggregate(" in plan._jc.toString()
