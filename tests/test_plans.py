"""What the physical plans must and must not contain."""

import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF, final_plan

QUESTIONS = entry_point.queries()


def plan(spark, name):
    return final_plan(QUESTIONS[name](spark, SF))


@pytest.mark.parametrize("name", ["q03_rfm_segments", "q45_rfm_scores", "e3_dim_customer_initial"])
def test_global_orders_do_not_meet_in_one_task(spark, name):
    assert "SinglePartition" not in plan(spark, name)


@pytest.mark.parametrize("name", ["q08_never_ordered_users", "q12_unsold_products"])
def test_missing_partners_are_anti_joins(spark, name):
    assert "LeftAnti" in plan(spark, name)


@pytest.mark.parametrize(
    "name", ["q07_top10_customers_by_orders", "q30_largest_order", "q43_top10_bulk_baskets", "l4_top20_orders"]
)
def test_top_lists_are_not_sorted_whole(spark, name):
    found = plan(spark, name)
    assert "TakeOrderedAndProject" in found
    assert "rangepartitioning" not in found


@pytest.mark.parametrize("name", ["q01_top3_products_by_revenue", "q46_top3_products_by_units", "v1_topk_cosine"])
def test_top_k_per_group_is_cut_before_the_shuffle(spark, name):
    found = plan(spark, name)
    assert "WindowGroupLimit" in found and "Partial" in found


@pytest.mark.parametrize(
    "name",
    [
        "l3_order_lines_lookup",
        "l2_email_prefix_clustered",
        "l2_email_suffix_clustered",
        "l5_status_date_filter_clustered",
        "l5_status_date_filter_curve",
    ],
)
def test_selective_reads_push_their_filter(spark, name):
    found = plan(spark, name)
    pushed = [p.split("]")[0] for p in found.split("PushedFilters: [")[1:]]
    assert any("EqualTo" in p or "StringStartsWith" in p for p in pushed)


@pytest.mark.parametrize("name", ["l1_range_filter", "l5_status_date_filter"])
def test_ranges_of_computed_times_bound_the_stored_dates(spark, name):
    assert "GreaterThan(o_orderdate," in plan(spark, name)


def test_range_lookup_is_an_equi_join(spark):
    found = plan(spark, "q42_price_as_of_order")
    assert "NestedLoop" not in found and "Cartesian" not in found


def test_lines_are_not_sorted_to_meet_their_orders(spark):
    found = plan(spark, "q42_price_as_of_order")
    assert "ShuffledHashJoin [order_id" in found and "SortMergeJoin [order_id" not in found


def test_scans_read_only_needed_columns(spark):
    found = plan(spark, "x03_avg_fare_by_vendor")
    assert "ReadSchema: struct<l_extendedprice:double,l_linestatus:string>" in found


def test_gaps_need_no_window_per_user(spark, shop):
    from mercato.operators.series import order_gaps

    found = final_plan(order_gaps(shop.orders, "user_id", "created_at"))
    assert "hashpartitioning" not in found and "user_id" not in found.split("Window")[-1].split("Exchange")[0]


def test_filtered_days_prune_the_facts_folders(spark, shop):
    from mercato.warehouse.load import star_of

    assert "SubqueryBroadcast dynamicpruning" in plan(spark, "d05_months_of_quarter_dwh")
    loaded = star_of(shop)
    days = loaded.table("dim_date").filter("year = 1997 AND quarter = 2")
    lines = loaded.fact_on_days("fct_order_items", days)
    lines.collect()
    nodes = [lines._jdf.queryExecution().executedPlan()]
    read = []
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            nodes.append(node.plan())
        if name.startswith("Scan parquet") and "numPartitions" in str(node.metrics().keySet()):
            read.append(node.metrics().apply("numPartitions").value())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.length())]
    assert 3 in read, read


def test_bucketed_facts_join_without_an_exchange(spark, shop):
    from mercato.warehouse.load import star_of

    loaded = star_of(shop)
    lines, orders = (loaded.bucketed(n) for n in ("fct_order_items", "fct_orders"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = final_plan(lines.join(orders.drop("date_id"), "order_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in found and "Exchange" not in found


def test_rolling_means_are_ranged_once(spark):
    """After the join: by product and day for the sums, by ranges of products for window and order."""
    found = plan(spark, "q04_rolling7_product_sales")
    assert found.count("rangepartitioning") == 1
    assert "hashpartitioning(product_id" not in found.split("rangepartitioning")[0]
