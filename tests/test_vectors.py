import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import vectors
from mercato.operators.linear import covariance, pca, ridge_fit
from mercato.operators.vectors import nearest
from tests.conftest import SF, rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )


def brute(corpus, queries, k, metric):
    ids = np.array([r["id"] for r in corpus.collect()])
    data = np.array([r["vector"] for r in corpus.collect()], dtype=float)
    found = []
    for row in queries.collect():
        q = np.array(row["vector"], dtype=float)
        if metric == "cosine":
            score = data @ q / np.linalg.norm(data, axis=1) / np.linalg.norm(q)
            order = np.lexsort((ids, -np.round(score, 9)))[:k]
        else:
            score = np.linalg.norm(data - q, axis=1)
            order = np.lexsort((ids, np.round(score, 9)))[:k]
        found += [(row["id"], int(ids[i]), rank) for rank, i in enumerate(order, 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("block", [4, 1_024])
def test_nearest_equals_brute_force(corpus, monkeypatch, metric, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    queries = corpus.filter("id < 10")
    found = nearest(corpus.repartition(5), queries, 7, metric).select("query_id", "id", "rank")
    assert rows(found) == brute(corpus, queries, 7, metric)


def test_copies_of_one_vector_are_cut_by_id(spark):
    corpus = spark.range(3_000).select("id", F.array(F.lit(1.0), F.lit(0.0)).alias("vector"))
    query = spark.createDataFrame([(1, [1.0, 0.0])], "id bigint, vector array<double>")
    found = nearest(corpus.repartition(6), query, 4)
    assert [r["id"] for r in found.orderBy("rank").collect()] == [0, 1, 2, 3]


def test_unit_vectors_rank_alike_by_both_metrics(corpus):
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    unit = corpus.select("id", F.transform(F.col("vector"), lambda x: x / norm).alias("vector"))
    queries = unit.filter("id < 5")
    cosine, l2 = (nearest(unit, queries, 5, m).select("query_id", "id", "rank") for m in vectors.METRICS)
    assert rows(cosine) == rows(l2)


def test_no_queries_and_bad_metric(corpus):
    assert nearest(corpus, corpus.filter("id < 0"), 3).count() == 0
    with pytest.raises(ValueError):
        nearest(corpus, corpus, 3, "hamming")


def test_covariance_is_symmetric_psd_and_matches_numpy(corpus):
    found = covariance(corpus.repartition(4), "vector").collect()
    data = np.array([r["vector"] for r in corpus.collect()], dtype=float)
    expected = np.cov(data, rowvar=False)
    for i, j, value in found:
        assert abs(value - expected[i, j]) < 1e-9
    assert np.linalg.eigvalsh(expected).min() > -1e-9


def test_principal_components_explain_the_variance(corpus):
    data = np.array([r["vector"] for r in corpus.collect()], dtype=float)
    found = pca(corpus, "vector", data.shape[1]).orderBy("component").collect()
    variances = [r["variance"] for r in found]
    assert variances == sorted(variances, reverse=True)
    assert abs(sum(r["share"] for r in found) - 1) < 1e-9
    first = np.array(found[0]["loadings"])
    projected = (data - data.mean(axis=0)) @ first
    assert abs(projected.var(ddof=1) - variances[0]) < 1e-9


def test_ridge_recovers_a_plane_and_shrinks(spark):
    i = F.col("id")
    df = spark.range(500).select(
        (i % 7).cast("double").alias("a"), (i % 11).cast("double").alias("b")
    ).withColumn("y", 3 + 2 * F.col("a") - 5 * F.col("b"))
    fit = dict(rows(ridge_fit(df, ["a", "b"], "y")))
    assert abs(fit["intercept"] - 3) < 1e-9 and abs(fit["a"] - 2) < 1e-9 and abs(fit["b"] + 5) < 1e-9
    shrunk = dict(rows(ridge_fit(df, ["a", "b"], "y", 1_000.0)))
    assert abs(shrunk["a"]) < 2 and abs(shrunk["b"]) < 5


def test_ridge_solves_collinear_features(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b")
    ).withColumn("y", F.col("a"))
    fit = dict(rows(ridge_fit(df, ["a", "b"], "y", 0.1)))
    assert abs(fit["a"] + 2 * fit["b"] - 1) < 1e-3


def test_covariance_far_from_zero_keeps_its_digits(spark):
    """Plain sums of products would lose them all: values near 1e8, variance 1/12."""
    df = spark.range(20_000).select(
        F.array(*[F.lit(1e8) + (F.abs(F.xxhash64("id", F.lit(i))) % 1_000_000) / 1e6 for i in range(3)]).alias("v")
    )
    found = {(r["i"], r["j"]): r["covariance"] for r in covariance(df.repartition(5), "v").collect()}
    data = np.array([r["v"] for r in df.collect()])
    expected = np.cov((data - data.mean(axis=0)).T)
    for (i, j), value in found.items():
        assert value == pytest.approx(expected[i, j], rel=1e-7, abs=1e-9)
    assert all(r["variance"] > 0 for r in pca(df, "v", 3).collect())
