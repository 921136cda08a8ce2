import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from mercato.operators.distinct import BOUND, estimate, monthly_sketches, within_bound
from tests.conftest import SF, final_plan


@pytest.mark.parametrize("users", [0, 1, 50, 30_000])
def test_merged_months_are_within_the_bound(spark, users):
    """A third of all rows is one user's; months overlap; NULL is not counted."""
    i = F.col("id")
    df = spark.range(users * 3).select(
        F.when(i % 3 == 0, 0).when(i % 7 == 1, None).otherwise(i % max(1, users)).alias("user"),
        F.timestamp_add("DAY", i % 700, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.lit(2).alias("v"),
    )
    months = monthly_sketches(df, "ts", {"users": "user"}, {"v": F.sum("v")})
    assert months.count() == (23 if users > 50 else months.select("month").distinct().count())
    found = estimate(months, ["users"], v=F.sum("v")).first()
    exactly = df.agg(F.count_distinct("user")).first()[0]
    assert abs((found["users"] or 0) - exactly) <= BOUND * exactly
    assert (found["v"] or 0) == 6 * users
    yearly = {r["y"]: r["users"] for r in estimate(months, ["users"], [F.year("month").alias("y")]).collect()}
    for r in df.groupBy(F.year("ts").alias("y")).agg(F.count_distinct("user").alias("n")).collect():
        assert abs(yearly[r["y"]] - r["n"]) <= BOUND * r["n"]


def test_arpu_is_near_the_exact_one(spark):
    questions = entry_point.queries()
    exact = questions["q36_arpu"](spark, SF).first()["arpu"]
    near = questions["q36_arpu_approx"](spark, SF).first()["arpu_estimated"]
    assert abs(float(near - exact)) <= 2 * BOUND * float(exact)


def test_no_key_is_shuffled(spark, shop):
    months = monthly_sketches(shop.orders, "created_at", {"users": "user_id"})
    found = final_plan(estimate(months, ["users"]))
    assert "hashpartitioning" not in found
    assert spark.range(1).select(within_bound(F.lit(98), F.lit(100)), within_bound(F.lit(90), F.lit(100))).first()[:] == (True, False)
