import subprocess
import sys
from statistics import median

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from mercato.operators import ranks
from mercato.operators.ranks import Ordering, add_ntiles, median_of, rows_at, surrogate_key
from tests.conftest import final_plan


@pytest.fixture(params=[(8, 2), (200, 40), (4_096, 4_096)])
def small(request, monkeypatch):
    """Coarse sketches and few picked rows need many narrowing rounds, others few or none."""
    sketch, picked = request.param
    monkeypatch.setattr(ranks, "SKETCH", sketch)
    monkeypatch.setattr(ranks, "PICKED", picked)


def frame(spark, n):
    """A tied key, a nearly unique one, a hot one and one with NULLs."""
    i = F.col("id")
    return spark.range(n).select(
        i,
        (F.xxhash64(i) % 7).alias("tied"),
        ((F.xxhash64(i) % 1_000_000) / F.lit(100)).cast("decimal(12,2)").alias("spread"),
        F.when(i % 3 == 0, F.lit(42)).otherwise(F.xxhash64(i + 1) % 1000).alias("hot"),
        F.when(i % 5 != 0, F.xxhash64(i) % 50).alias("gappy"),
        F.lit(1).alias("same"),
    )


def builtin(df, key, descending, k):
    first = F.col(key).desc_nulls_first() if descending else F.col(key).asc_nulls_last()
    return df.withColumn("expected", F.ntile(k).over(Window.orderBy(first, "id")))


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 6, 1_000])
@pytest.mark.parametrize("descending", [False, True])
def test_ntile_equals_builtin(spark, small, n, descending):
    df = frame(spark, n)
    keys = ("tied", "spread", "hot", "gappy", "same")
    tiled = add_ntiles(df, {f"t_{c}": Ordering(c, "id", descending) for c in keys}, 4)
    for key in keys:
        wrong = builtin(tiled, key, descending, 4).filter(F.col(f"t_{key}") != F.col("expected"))
        assert wrong.count() == 0, key


def test_ntile_on_many_rows(spark):
    df = frame(spark, 40_000)
    tiled = add_ntiles(df, {"tile": Ordering("hot", "id")}, 7)
    assert builtin(tiled, "hot", False, 7).filter("tile != expected").count() == 0
    sizes = [r["count"] for r in tiled.groupBy("tile").count().orderBy("tile").collect()]
    assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)
    assert "SinglePartition" not in final_plan(tiled)
    assert "Exchange" not in final_plan(tiled)


def test_every_position_is_found(spark, small):
    df = frame(spark, 20)
    for descending in (False, True):
        order = Ordering("gappy", "id", descending)
        found = rows_at(df, [(order, i) for i in range(1, 21)], *ranks._sizes(df, {"gappy"}))
        pairs = [(r["gappy"], r["id"]) for r in df.collect()]
        pairs.sort(key=lambda p: p[1])
        if descending:
            pairs.sort(key=lambda p: (p[0] is not None, -(p[0] or 0)))
        else:
            pairs.sort(key=lambda p: (p[0] is None, p[0] or 0))
        assert found == pairs


@pytest.mark.parametrize("values", [[5], [1, 2], [3, 3, 3, 9], list(range(101)), [7] * 50 + [1, 2]])
def test_median_is_exact(spark, small, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert median_of(df, "v") == 2 * median(values)


def test_large_repeated_values_end(spark):
    """Approximate quantiles miss such values: 2^60 + 1 is no double."""
    value = (1 << 60) + 1
    df = spark.range(20_000).select(
        F.when(F.col("id") < 12_000, F.lit(value)).otherwise(F.lit(value) + F.col("id")).alias("v"), "id"
    )
    assert median_of(df, "v") == 2 * value
    tiled = add_ntiles(df, {"tile": Ordering("v", "id")}, 4)
    assert builtin(tiled, "v", False, 4).filter("tile != expected").count() == 0


def test_nine_searches_take_four_jobs(spark, monkeypatch):
    """Sizes, sketches, counts, rows; each fetches a single row."""
    df = frame(spark, 40_000)
    jobs = []
    agg = type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *c: jobs.append(len(c)) or agg(self, *c))
    monkeypatch.setattr(type(df), "toLocalIterator", None)
    specs = {"a": Ordering("spread", "id"), "b": Ordering("hot", "id", True), "c": Ordering("id", "id")}
    tiled = add_ntiles(df, specs, 4)
    assert len(jobs) == 4 and jobs[1] == 3
    for name, key, down in (("a", "spread", False), ("b", "hot", True)):
        assert builtin(tiled, key, down, 4).filter(F.col(name) != F.col("expected")).count() == 0


def test_values_next_to_each_other_in_doubles_are_told_apart(spark, monkeypatch):
    """Sketches of decimals hold doubles: rows they cannot tell apart are split by lot."""
    monkeypatch.setattr(ranks, "PICKED", 5)
    df = spark.range(300).select(
        ((F.col("id") % 40).cast("decimal(30,2)") / 100 + F.lit("12345678901234567890").cast("decimal(30,2)")).cast("decimal(30,2)").alias("v"),
        "id",
    )
    tiled = add_ntiles(df, {"up": Ordering("v", "id"), "down": Ordering("v", "id", True)}, 4)
    for name, down in (("up", False), ("down", True)):
        assert builtin(tiled, "v", down, 4).filter(F.col(name) != F.col("expected")).count() == 0


def test_median_of_nothing(spark):
    assert median_of(spark.createDataFrame([], "v bigint"), "v") is None
    assert median_of(spark.createDataFrame([(None,), (4,), (None,)], "v bigint"), "v") == 8


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = frame(spark, 10_000).repartition(13)
    keyed = surrogate_key(df, ["hot", "id"], "sk", start=100)
    wrong = keyed.withColumn("expected", F.row_number().over(Window.orderBy("hot", "id")) + 100)
    assert wrong.filter("sk != expected").count() == 0
    assert keyed.count() == 10_000


def test_surrogate_keys_spread_a_hot_leading_column(spark):
    """Rows equal in the first column still land in several ranges."""
    df = spark.range(100_000).withColumn("hot", F.lit(1))
    spread = df.repartitionByRange(8, "hot", "id").groupBy(F.spark_partition_id()).count()
    assert spread.count() > 1


def test_surrogate_key_of_nothing(spark):
    assert surrogate_key(frame(spark, 0), ["id"], "sk").count() == 0


@pytest.mark.parametrize("large", [1 << 20, 3])
def test_keys_in_groups_are_those_over_all_rows(spark, monkeypatch, large):
    """Unknown, missing, repeated and large groups; rows equal in the whole key; NULLs in it."""
    monkeypatch.setattr(ranks, "LARGE_GROUP", large)
    i = F.col("id")
    df = spark.range(400).select(
        F.when(i % 4 == 0, F.lit(20)).when(i % 4 == 1, F.lit(21)).when(i % 31 != 0, F.xxhash64(i) % 40).alias("lead"),
        F.when(i % 9 != 0, F.xxhash64(i) % 11).alias("next"),
        (i % 3).alias("last"),
    ).repartition(5)
    groups = spark.createDataFrame([(k,) for k in [*range(-39, 40, 2), 20, 7, 7, None]], "k bigint")
    key = ["lead", "next", "last"]
    known = df.join(groups.withColumnRenamed("k", "lead"), "lead", "left_semi")
    plain = known.withColumn("sk", F.row_number().over(Window.orderBy(*key)).cast("bigint"))
    found = ranks.surrogate_key_in_groups(df, key, groups, "sk")
    assert found.columns == plain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.select(*found.columns).collect()))


def test_keys_in_groups_of_nothing(spark):
    df, none = frame(spark, 5), spark.createDataFrame([], "k bigint")
    assert ranks.surrogate_key_in_groups(df, ["id", "tied"], none, "sk").count() == 0
    assert ranks.surrogate_key_in_groups(frame(spark, 0), ["id", "tied"], none, "sk").count() == 0


def test_task_functions_travel_with_the_job(tmp_path):
    """A worker without a copy of the package can load what a task runs."""
    packed = tmp_path / "function"
    packed.write_bytes(cloudpickle.dumps(ranks._totals_before))
    code = f"import pickle; print(pickle.load(open({str(packed)!r}, 'rb')).__name__)"
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "_totals_before", done.stderr
