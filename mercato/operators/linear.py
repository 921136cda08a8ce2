"""Linear algebra over tall tables: the data is reduced to a small matrix, which is solved locally."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from fractions import Fraction
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Task functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Widest matrix that may come to the driver.
MAX_WIDTH = 2_000
# More features than these are fitted from triangular factors instead of sums of all products.
MAX_TERMS = 100
# Features of such a fit: a factor of 32 MB.
MAX_FACTOR = 2_000
# Factors or sums that meet in one merge, rows of one factorization.
FAN_IN = 8
FACTOR_ROWS = 4_096
# Directions beyond the wanted ones, and passes that sharpen the sketch of the range.
OVERSAMPLED, PASSES = 10, 6


def ridge_fit(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.0) -> DataFrame:
    """(term, coefficient) of least squares with a ridge on the slopes.

    One aggregation yields all sums of products; centring them in exact arithmetic avoids the loss
    of digits that makes the plain normal equations unstable.  The p x p system is solved by
    Cholesky factors, never by an inverse.
    """
    if len(features) > MAX_TERMS:
        values = F.array(*[F.col(c).cast("double") for c in [*features, label]])
        complete = df.select(*features, label).dropna().select(values.alias("v"))
        slopes = _solved(_factor(complete, len(features) + 1), len(features), penalty)
        terms = list(zip(["intercept", *features], slopes, strict=True))
        return df.sparkSession.createDataFrame(terms, "term string, coefficient double")
    columns = [*features, label]
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    complete = df.select(*columns).dropna()
    sums = [F.sum(c) for c in columns]
    products = [F.sum(F.col(columns[i]) * F.col(columns[j])) for i, j in pairs]
    row = complete.agg(F.count(F.lit(1)), *sums, *products).first()
    n = row[0]
    if n == 0:
        raise ValueError("no complete rows")
    totals = [Fraction(v) for v in row[1 : 1 + len(columns)]]
    centred = np.zeros((len(columns), len(columns)))
    for (i, j), value in zip(pairs, row[1 + len(columns) :]):
        centred[i, j] = centred[j, i] = float(Fraction(value) - totals[i] * totals[j] / n)
    p = len(features)
    system = centred[:p, :p] + penalty * np.eye(p)
    lower = np.linalg.cholesky(system)
    slopes = np.linalg.solve(lower.T, np.linalg.solve(lower, centred[:p, p]))
    means = [float(t / n) for t in totals]
    intercept = means[p] - float(np.dot(slopes, means[:p]))
    terms = [("intercept", intercept), *zip(features, map(float, slopes))]
    return df.sparkSession.createDataFrame(terms, "term string, coefficient double")


def _merged(records: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One matrix out of a column of matrices, merged ``FAN_IN`` at a time in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for record in batch.column(0).to_pylist():
                held.append(_unpacked(record))
                if len(held) >= FAN_IN:
                    held = [merge(held)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([_packed(merge(held))], pa.binary())], names=["record"])

    parts = max(1, records.rdd.getNumPartitions())
    while True:
        parts = -(-parts // FAN_IN)
        records = records.repartition(parts).mapInArrow(run, "record binary")
        if parts == 1:
            break
    found = [_unpacked(bytes(r["record"])) for r in records.collect()]
    return merge(found) if found else None


def _packed(matrix: np.ndarray) -> bytes:
    return np.array(matrix.shape, np.int64).tobytes() + np.ascontiguousarray(matrix, np.float64).tobytes()


def _unpacked(record: bytes) -> np.ndarray:
    rows, columns = np.frombuffer(record, np.int64, 2)
    return np.frombuffer(record, np.float64, -1, 16).reshape(rows, columns)


def _triangular(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _factor(rows: DataFrame, width: int) -> np.ndarray:
    """The triangular factor of the matrix [1, v] over all rows, from a tree of small factorizations.

    A task holds ``FACTOR_ROWS`` rows and one factor; the products of columns, whose rounding would double
    the digits lost, are never formed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.empty((0, width + 1))
        for batch in batches:
            values = _rows(batch)
            for at in range(0, batch.num_rows, FACTOR_ROWS):
                part = values[at : at + FACTOR_ROWS]
                factor = _triangular([factor, np.hstack([np.ones((len(part), 1)), part])])
        if len(factor):
            yield pa.RecordBatch.from_arrays([pa.array([_packed(factor)], pa.binary())], names=["record"])

    if width > MAX_FACTOR:
        raise ValueError(f"at most {MAX_FACTOR} features")
    factor = _merged(rows.mapInArrow(run, "record binary"), _triangular)
    if factor is None:
        raise ValueError("no complete rows")
    # Fewer rows than columns leave a factor that is not square.
    return np.vstack([factor, np.zeros((max(0, width + 1 - len(factor)), width + 1))])


def _solved(factor: np.ndarray, p: int, penalty: float) -> list[float]:
    """Intercept and slopes: below the row of the ones stands the factor of the centred columns."""
    inner, target = factor[1 : p + 1, 1 : p + 1], factor[1 : p + 1, p + 1]
    system = np.vstack([inner, np.sqrt(penalty) * np.eye(p)])
    slopes = np.linalg.lstsq(system, np.concatenate([target, np.zeros(p)]), rcond=None)[0]
    intercept = (factor[0, p + 1] - factor[0, 1 : p + 1] @ slopes) / factor[0, 0]
    return [float(intercept), *map(float, slopes)]


def ridge_fit_vector(df: DataFrame, vector: str, label: str, penalty: float = 0.0) -> DataFrame:
    """(position, coefficient): a label explained by all positions of a vector, the intercept at -1.

    Rows without a vector or label are left out; vectors are of one width.
    """
    known = df.filter(F.col(vector).isNotNull() & F.col(label).isNotNull())
    values = F.concat(F.col(vector).cast("array<double>"), F.array(F.col(label).cast("double")))
    rows = known.select(values.alias("v"))
    first = rows.select(F.size("v")).first()
    if first is None:
        raise ValueError("no complete rows")
    slopes = _solved(_factor(rows, first[0]), first[0] - 1, penalty)
    return df.sparkSession.createDataFrame(list(enumerate(slopes, -1)), "position int, coefficient double")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's sums per position."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            rows = _rows(batch)
            n += batch.num_rows
            total = rows.sum(axis=0) if total is None else total + rows.sum(axis=0)
    if total is not None:
        places = pa.array(np.arange(len(total), dtype=np.int32))
        counts = pa.array(np.full(len(total), n, dtype=np.int64))
        yield pa.RecordBatch.from_arrays([places, counts, pa.array(total)], names=["i", "n", "s"])


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    flat = np.asarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(batch.num_rows, -1)


def _comoments(
    centre: np.ndarray,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One task's sums and sums of products of what is left after ``centre``, for positions i <= j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, cross = 0, np.zeros(len(centre)), np.zeros((len(centre),) * 2)
        for batch in batches:
            if batch.num_rows:
                rows = _rows(batch) - centre
                n += batch.num_rows
                total += rows.sum(axis=0)
                cross += rows.T @ rows
        if n:
            i, j = np.triu_indices(len(centre))
            counts = np.full(len(i), n, dtype=np.int64)
            places = [pa.array(x.astype(np.int32)) for x in (i, j)]
            sums = [pa.array(x) for x in (counts, total[i], total[j], cross[i, j])]
            yield pa.RecordBatch.from_arrays([*places, *sums], names=["i", "j", "n", "si", "sj", "sij"])

    return run


def covariance(df: DataFrame, vector: str) -> DataFrame:
    """(i, j, covariance) for i <= j: the sample covariance of the vector's positions.

    A first pass takes the means (one number per position reaches the driver, at most ``MAX_WIDTH``),
    the second sums products of what is left after them, so values far from zero lose no digits.  Each
    task sends one number per pair of positions, whatever its number of rows.
    """
    vectors = df.select(F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    if width > MAX_WIDTH:
        raise ValueError(f"vectors wider than {MAX_WIDTH}")
    sums = vectors.mapInArrow(_sums, "i int, n bigint, s double").groupBy("i")
    centre = np.zeros(width)
    for i, n, total in sums.agg(F.sum("n"), F.sum("s")).collect():
        centre[i] = total / n
    partial = vectors.mapInArrow(
        _comoments(centre), "i int, j int, n bigint, si double, sj double, sij double"
    )
    sums = partial.groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "si", "sj", "sij")]
    )
    # What the rounded means leave over.
    centred = F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    return sums.select("i", "j", (centred / F.nullif(F.col("n") - 1, F.lit(0))).alias("covariance"))


def pca(df: DataFrame, vector: str, k: int) -> DataFrame:
    """(component, variance, share, loadings): the ``k`` directions of largest variance.

    Only the covariance matrix, whose width is checked, comes to the driver.
    """
    entries = covariance(df, vector).collect()
    if not entries:
        raise ValueError("no vectors")
    width = max(j for _, j, _ in entries)
    symmetric = np.zeros((width + 1, width + 1))
    for i, j, value in entries:
        symmetric[i, j] = symmetric[j, i] = value
    values, directions = np.linalg.eigh(symmetric)
    total = float(values.sum())
    components = []
    for place, at in enumerate(np.argsort(values)[::-1][:k], 1):
        loading = directions[:, at]
        loading = loading * np.sign(loading[np.argmax(np.abs(loading))])
        components.append((place, float(values[at]), float(values[at]) / total, loading.tolist()))
    schema = "component int, variance double, share double, loadings array<double>"
    return df.sparkSession.createDataFrame(components, schema)


def pca_wide(df: DataFrame, vector: str, k: int, seed: int = 1) -> DataFrame:
    """The same as ``pca`` for vectors of any width: no matrix of width by width is formed anywhere.

    A random sketch of the range is sharpened by passes over the rows: each task sends, for ``k`` and a
    few more directions, what its rows make of them, one number per position and direction.
    """
    vectors = df.select(F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull())
    moments = vectors.mapInArrow(_sums, "i int, n bigint, s double").groupBy("i").agg(F.sum("n"), F.sum("s"))
    rows = sorted(moments.collect())
    if not rows:
        raise ValueError("no vectors")
    count, width = rows[0][1], len(rows)
    centre = np.array([total / n for _, n, total in rows])
    size = min(width, k + OVERSAMPLED)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]

    def passed(basis: np.ndarray) -> np.ndarray:
        """The covariance times the basis, and below it the total variance."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, square, seen = np.zeros((width, size)), 0.0, False
            for batch in batches:
                if batch.num_rows:
                    part, seen = _rows(batch) - centre, True
                    total += part.T @ (part @ basis)
                    square += float((part * part).sum())
            if seen:
                whole = np.vstack([total, np.full((1, size), square)])
                yield pa.RecordBatch.from_arrays([pa.array([_packed(whole)], pa.binary())], names=["record"])

        return _merged(vectors.mapInArrow(run, "record binary"), lambda parts: np.sum(parts, axis=0)) / max(1, count - 1)

    for _ in range(PASSES):
        basis = np.linalg.qr(passed(basis)[:-1])[0]
    found = passed(basis)
    values, turn = np.linalg.eigh(basis.T @ found[:-1])
    directions, whole = basis @ turn, float(found[-1, 0])
    components = []
    for place, at in enumerate(np.argsort(values)[::-1][:k], 1):
        loading = directions[:, at]
        loading = loading * np.sign(loading[np.argmax(np.abs(loading))])
        share = float(values[at]) / whole if whole else 0.0
        components.append((place, float(values[at]), share, loading.tolist()))
    schema = "component int, variance double, share double, loadings array<double>"
    return df.sparkSession.createDataFrame(components, schema)
