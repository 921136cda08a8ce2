"""Vector search, ridge regression and principal components over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.operators.linear import covariance, pca, pca_wide, ridge_fit, ridge_fit_vector
from mercato.operators.vectors import centroids, nearest
from mercato.plans import Registry
from mercato.sources.shop import Shop

QUESTIONS = Registry()
question = QUESTIONS.question

NEIGHBOURS = 10
RIDGE = 1.0
COMPONENTS = 8


def _corpus(shop: Shop) -> DataFrame:
    return shop.given("embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def _near_centroids(shop: Shop, metric: str) -> DataFrame:
    """The vectors nearest to the centre of every label."""
    corpus = _corpus(shop)
    found = nearest(corpus, centroids(corpus, "label"), NEIGHBOURS, metric)
    return found.select(
        F.col("query_id").alias("label"),
        F.col("id").alias("vec_id"),
        F.round("score", 6).alias("score"),
        "rank",
    )


@question
def v1_topk_cosine(shop: Shop) -> DataFrame:
    return _near_centroids(shop, "cosine")


@question
def v2_topk_l2(shop: Shop) -> DataFrame:
    return _near_centroids(shop, "l2")


@question
def v3_ridge_fit(shop: Shop) -> DataFrame:
    """Fare explained by distance and toll."""
    fit = ridge_fit(shop.trips, ["trip_distance", "tolls_amount"], "fare_amount", RIDGE)
    return fit.select("term", F.round("coefficient", 4).alias("coefficient"))


@question
def v4_covariance(shop: Shop) -> DataFrame:
    found = covariance(_corpus(shop), "vector")
    return found.select("i", "j", F.round("covariance", 8).alias("covariance"))


@question
def v4_principal_components(shop: Shop) -> DataFrame:
    found = pca(_corpus(shop), "vector", COMPONENTS)
    return found.select("component", F.round("variance", 8).alias("variance"), F.round("share", 8).alias("share"))


@question
def v3_ridge_fit_vector(shop: Shop) -> DataFrame:
    """The label explained by all positions, held against the normal equations over all rows."""
    corpus = shop.given("embeddings").select("embedding", "label")
    fit = ridge_fit_vector(corpus, "embedding", "label", RIDGE)
    terms = sorted(tuple(r) for r in fit.collect())
    intercept, slopes = terms[0][1], [c for _, c in terms[1:]]
    values = F.transform("embedding", lambda x: x.cast("double"))
    told = F.aggregate(F.zip_with(values, F.lit(slopes), lambda x, b: x * b), F.lit(intercept), lambda a, b: a + b)
    ones = F.concat(F.array(F.lit(1.0)), values).alias("v")
    left = corpus.select(ones, (F.col("label") - told).alias("left"))
    # Residuals sum to nothing; against a position they sum to the ridge on its slope.
    exploded = left.select("left", F.posexplode("v").alias("i", "x"))
    sums = exploded.groupBy("i").agg(F.sum(F.col("x") * F.col("left")).alias("s"), F.count(F.lit(1)).alias("n"))
    ridge = F.element_at(F.lit([0.0, *slopes]), F.col("i") + 1) * RIDGE
    return sums.agg(
        F.max("n").alias("rows"),
        F.count(F.lit(1)).alias("terms"),
        (F.max(F.abs(F.col("s") - ridge)) < 1e-6 * F.max("n")).alias("normal_equations_hold"),
    )


@question
def v4_pca_wide(shop: Shop) -> DataFrame:
    """Total variance, and whether directions found without the covariance matrix are its own."""
    found = pca_wide(_corpus(shop), "vector", COMPONENTS).sort("component").collect()
    entries = covariance(_corpus(shop), "vector")
    total = found[0]["variance"] / found[0]["share"]
    loadings = [list(r["loadings"]) for r in found]
    products = [sum(x * y for x, y in zip(a, b, strict=True)) for a in loadings for b in loadings]
    size = len(loadings)
    orthonormal = all(abs(v - (i // size == i % size)) < 1e-9 for i, v in enumerate(products))
    # Both triangles of the matrix, times every direction, less the direction times its variance.
    other = entries.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "covariance")
    both = entries.unionByName(other)
    images = both.groupBy("i").agg(
        *[F.sum(F.element_at(F.lit(v), F.col("j") + 1) * F.col("covariance")).alias(f"w{n}") for n, v in enumerate(loadings)]
    )
    off = [
        F.max(F.abs(F.col(f"w{n}") - F.element_at(F.lit(v), F.col("i") + 1) * r["variance"]))
        for n, (v, r) in enumerate(zip(loadings, found, strict=True))
    ]
    return images.agg(F.greatest(*off, F.lit(0.0)).alias("off")).select(
        F.round(F.lit(total), 6).alias("total_variance"),
        F.lit(orthonormal).alias("orthonormal"),
        (F.col("off") < 1e-3 * F.lit(total)).alias("own_directions"),
    )
