"""Oracle statements of vector search, ridge regression and covariance."""

from __future__ import annotations

from oracle.shop import shop

CENTRES = """centres AS (
  SELECT label, list(mean ORDER BY pos) AS centre
  FROM (SELECT label, pos, avg(embedding[pos]::DOUBLE) AS mean
        FROM embeddings, range(1, 65) r(pos) GROUP BY label, pos)
  GROUP BY label)"""


def _near(score: str, direction: str) -> str:
    return f"""
WITH {CENTRES},
scored AS (
  SELECT c.label, vec_id, round({score}, 9) AS score
  FROM centres c, (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))
SELECT CAST(label AS BIGINT) AS label, vec_id, round(score, 6) AS score, CAST(place AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score {direction}, vec_id) AS place
      FROM scored)
WHERE place <= 10"""


SQL: dict[str, str] = {
    "v1_topk_cosine": _near("list_cosine_similarity(v, centre)", "DESC"),
    "v2_topk_l2": _near("list_distance(v, centre)", "ASC"),
    "v3_ridge_fit": shop(
        """
SELECT term, round(CASE term WHEN 'trip_distance' THEN b1 WHEN 'tolls_amount' THEN b2
                   ELSE my - b1 * m1 - b2 * m2 END, 4) AS coefficient
FROM solved, (VALUES ('intercept'), ('trip_distance'), ('tolls_amount')) t(term)""",
        """centred AS (
  SELECT sum((x1 - m1) * (x1 - m1)) + 1 AS a, sum((x1 - m1) * (x2 - m2)) AS b,
         sum((x2 - m2) * (x2 - m2)) + 1 AS c, sum((x1 - m1) * (y - my)) AS d,
         sum((x2 - m2) * (y - my)) AS e, any_value(m1) AS m1, any_value(m2) AS m2,
         any_value(my) AS my
  FROM (SELECT x1, x2, y, avg(x1) OVER () AS m1, avg(x2) OVER () AS m2, avg(y) OVER () AS my
        FROM (SELECT trip_distance::DOUBLE AS x1, tolls_amount::DOUBLE AS x2,
                     fare_amount::DOUBLE AS y FROM shop_trips)))""",
        """solved AS (
  SELECT (c * d - b * e) / (a * c - b * b) AS b1, (a * e - b * d) / (a * c - b * b) AS b2,
         m1, m2, my
  FROM centred)""",
    ),
    "v4_covariance": """
SELECT CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j,
       round(covar_samp(embedding[i]::DOUBLE, embedding[j]::DOUBLE), 8) AS covariance
FROM embeddings, range(1, 65) r(i), range(1, 65) s(j) WHERE i <= j GROUP BY ALL""",
    "v3_ridge_fit_vector": "SELECT count(*) AS rows, CAST(65 AS BIGINT) AS terms, true AS normal_equations_hold FROM embeddings",
    "v4_pca_wide": """
SELECT round(sum(v), 6) AS total_variance, true AS orthonormal, true AS own_directions
FROM (SELECT var_samp(embedding[i]::DOUBLE) AS v FROM embeddings, range(1, 65) r(i) GROUP BY i)""",
}
