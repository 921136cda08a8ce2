import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators.linear import pca, pca_wide, ridge_fit, ridge_fit_vector


def table(spark, matrix, parts=3):
    return spark.createDataFrame([(row,) for row in matrix.tolist()], "v array<double>").repartition(parts)


def test_hundreds_of_features_are_fitted(spark):
    """Columns that nearly depend on each other and lie far from zero, beyond what sums of products can tell."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1_500, 500)) + 1_000
    x[:, 1] = x[:, 0] + 1e-5 * rng.normal(size=1_500)
    slopes = rng.normal(size=500)
    y = x @ slopes + 7
    df = table(spark, np.hstack([x, y[:, None]])).select(F.slice("v", 1, 500).alias("v"), F.col("v")[500].alias("y"))
    found = {r["position"]: r["coefficient"] for r in ridge_fit_vector(df, "v", "y").collect()}
    assert len(found) == 501
    told = x @ np.array([found[i] for i in range(500)]) + found[-1]
    assert np.abs(told - y).max() < 1e-4 * np.abs(y).max()
    assert np.allclose([found[i] for i in range(2, 500)], slopes[2:], atol=1e-4)


@pytest.mark.parametrize("penalty", [0.0, 2.5])
def test_both_ways_to_fit_agree(spark, monkeypatch, penalty):
    rng = np.random.default_rng(2)
    data = [tuple(map(float, row)) for row in rng.normal(size=(300, 4)) + 5]
    df = spark.createDataFrame([*data, (None, 1.0, 1.0, 1.0)], "a double, b double, c double, y double")
    small = dict(ridge_fit(df, ["a", "b", "c"], "y", penalty).collect())
    monkeypatch.setattr("mercato.operators.linear.MAX_TERMS", 2)
    tall = dict(ridge_fit(df, ["a", "b", "c"], "y", penalty).collect())
    assert tall == pytest.approx(small, abs=1e-8)


def test_fewer_rows_than_features_and_none(spark):
    df = table(spark, np.eye(3)).withColumn("y", F.lit(2.0))
    found = [r["coefficient"] for r in ridge_fit_vector(df, "v", "y", 1.0).collect()]
    assert found == pytest.approx([2.0, 0, 0, 0], abs=1e-9)
    with pytest.raises(ValueError):
        ridge_fit_vector(df.limit(0), "v", "y")
    with pytest.raises(ValueError):
        pca_wide(df.limit(0), "v", 2)


def test_wide_components_are_those_of_the_covariance(spark):
    rng = np.random.default_rng(3)
    matrix = rng.normal(size=(400, 30)) * np.linspace(9, 1, 30) + 100
    df = table(spark, matrix)
    for whole, wide in zip(pca(df, "v", 3).collect(), pca_wide(df, "v", 3).collect()):
        assert wide["variance"] == pytest.approx(whole["variance"], rel=1e-3)
        assert wide["share"] == pytest.approx(whole["share"], rel=1e-3)


def test_thousands_of_positions(spark):
    """A plane in 5,000 positions and little noise."""
    rng = np.random.default_rng(4)
    plane = rng.normal(size=(120, 2)) @ (rng.normal(size=(2, 5_000)) * [[3.0], [1.0]])
    matrix = plane + 0.01 * rng.normal(size=(120, 5_000))
    found = pca_wide(table(spark, matrix), "v", 2).collect()
    values = np.linalg.svd(matrix - matrix.mean(axis=0), compute_uv=False) ** 2 / 119
    assert [r["variance"] for r in found] == pytest.approx(values[:2].tolist(), rel=1e-6)
    assert sum(r["share"] for r in found) > 0.99
    directions = np.array([r["loadings"] for r in found])
    assert np.allclose(directions @ directions.T, np.eye(2), atol=1e-9)
