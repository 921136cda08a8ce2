"""Exact nearest neighbours for a set of query vectors.

Every task scores its share of the corpus with numpy against some of the queries, keeps the best ``k``
per query, and only those reach the shuffle.  No pair of vectors becomes a row, and no number of queries
passes through the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.operators.topk import asc, desc, top_k_per_group

# Task functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Query vectors that travel with the tasks, or make a tile.
BLOCK = 1_024
# Rows of one block of the corpus, and tasks that the blocks meeting one tile are dealt to.
CORPUS_BLOCK = 4_096
SPREAD = 16
# Scores closer than this are ties and ordered by id.
DIGITS = 9

METRICS = ("cosine", "l2")


def _cosine(rows: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Similarity of every row with every query, one column per query."""
    lengths = np.outer(np.sqrt((rows * rows).sum(axis=1)), np.sqrt((block * block).sum(axis=1)))
    return np.divide(rows @ block.T, lengths, out=np.zeros_like(lengths), where=lengths > 0)


def _l2(rows: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Distances from differences: expanding the square would lose the digits of near vectors."""
    return np.stack([np.sqrt(((rows - query) ** 2).sum(axis=1)) for query in block], axis=1)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if len(flat) != len(column) * width:
        raise ValueError(f"every vector must have {width} elements")
    return flat.reshape(len(column), width)


def _best(ids: np.ndarray, scores: np.ndarray, k: int, descending: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best in order, ties to the smaller id; only what reaches the k-th score is sorted."""
    worth = -scores if descending else scores
    if len(worth) > k:
        near = np.flatnonzero(worth <= np.partition(worth, k - 1)[k - 1])
        ids, scores, worth = ids[near], scores[near], worth[near]
    order = np.lexsort((ids, worth))[:k]
    return ids[order], scores[order]


class _Lists:
    """The best rows seen so far for each of some queries."""

    def __init__(self, names: np.ndarray, block: np.ndarray, k: int, metric: str) -> None:
        self.names, self.block, self.k = names, block, k
        self.score, self.descending = (_cosine, True) if metric == "cosine" else (_l2, False)
        self.best = [(np.empty(0, np.int64), np.empty(0))] * len(names)

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = np.round(self.score(rows, self.block), DIGITS)
        for i, (known_ids, known) in enumerate(self.best):
            near_ids, near = _best(ids, scores[:, i], self.k, self.descending)
            joined = np.concatenate([known_ids, near_ids]), np.concatenate([known, near])
            self.best[i] = _best(*joined, self.k, self.descending)

    def rows(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.best]
        columns = [
            np.repeat(self.names, counts),
            np.concatenate([ids for ids, _ in self.best]),
            np.concatenate([scores for _, scores in self.best]),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score"])


FOUND = "query_id bigint, id bigint, score double"


def _streamed(vectors: DataFrame, rows: list, k: int, metric: str) -> DataFrame:
    """Few queries travel with the tasks: the corpus is read where it lies."""
    names = np.array([row["id"] for row in rows], dtype=np.int64)
    block = np.array([row["vector"] for row in rows], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = _Lists(names, block, k, metric)
        for batch in batches:
            lists.add(batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), block.shape[1]))
        yield lists.rows()

    return vectors.mapInArrow(run, FOUND)


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows of (id, vector) as blocks of up to ``most``: width, ids and vectors as bytes."""

    def out(ids: list, vectors: list) -> pa.RecordBatch:
        matrix = np.concatenate(vectors)
        record = np.int64(matrix.shape[1]).tobytes() + np.concatenate(ids).astype(np.int64).tobytes() + matrix.tobytes()
        return pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], names=["block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[np.ndarray] = []
        vectors: list[np.ndarray] = []
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                ids.append(batch.column(0).to_numpy(zero_copy_only=False))
                width = len(batch.column(1)[0])
                vectors.append(_matrix(batch.column(1), vectors[0].shape[1] if vectors else width))
                if sum(map(len, ids)) >= most:
                    yield out(ids, vectors)
                    ids, vectors = [], []
        if ids:
            yield out(ids, vectors)

    return rows.mapInArrow(run, "block binary")


def _unpacked(record: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = int(np.frombuffer(record, np.int64, 1)[0])
    count = (len(record) - 8) // (8 * (width + 1))
    ids = np.frombuffer(record, np.int64, count, 8)
    return ids, np.frombuffer(record, np.float64, count * width, 8 + 8 * count).reshape(count, width)


def _tiled(vectors: DataFrame, queries: DataFrame, count: int, k: int, metric: str) -> DataFrame:
    """Many queries, in tiles: every tile meets all blocks of the corpus, dealt to ``SPREAD`` tasks."""
    gathered = _packed(queries.repartition(-(-count // BLOCK)), BLOCK).withColumn("tile", F.monotonically_increasing_id())
    tiles = scratch.materialize(gathered, "tiles")
    numbered = _packed(vectors, CORPUS_BLOCK).withColumn("n", F.monotonically_increasing_id())
    blocks = scratch.materialize(numbered, "blocks")
    # One number per tile of queries.
    names = [row["tile"] for row in tiles.select("tile").collect()]
    parts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    asking = tiles.select("tile", parts.alias("part"), F.lit(-1).cast("bigint").alias("n"), "block")
    place = F.shiftright("n", 33) + F.col("n").bitwiseAND(F.lit((1 << 33) - 1))
    passing = blocks.select(
        F.explode(F.lit(names).cast("array<bigint>")).alias("tile"), F.pmod(place, F.lit(SPREAD)).cast("int").alias("part"), "n", "block"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: _Lists | None = None
        for batch in batches:
            for n, record in zip(batch.column(2), batch.column(3), strict=True):
                ids, matrix = _unpacked(record.as_py())
                if n.as_py() >= 0:
                    if matrix.shape[1] != lists.block.shape[1]:
                        raise ValueError(f"every vector must have {lists.block.shape[1]} elements")
                    lists.add(ids, matrix)
                    continue
                if lists is not None:
                    yield lists.rows()
                lists = _Lists(ids, matrix, k, metric)
        if lists is not None:
            yield lists.rows()

    # A cell's queries come before the blocks that pass it.
    cells = asking.unionByName(passing).repartition(len(names) * SPREAD, "tile", "part")
    return cells.sortWithinPartitions("tile", "part", "n").mapInArrow(run, FOUND)


def nearest(
    corpus: DataFrame, queries: DataFrame, k: int, metric: str = "cosine"
) -> DataFrame:
    """(query_id, id, score, rank) of the ``k`` corpus vectors nearest to every query vector.

    Both frames hold (id bigint, vector array).  Up to ``BLOCK`` queries travel with the tasks in one pass
    over the corpus; more are packed into tiles that the corpus' blocks are sent to.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    order = [desc("score") if metric == "cosine" else asc("score")]
    columns = F.col("id").cast("bigint"), F.col("vector").cast("array<double>").alias("vector")
    vectors, asked = (df.select(*columns).filter(F.col("vector").isNotNull()) for df in (corpus, queries))
    few = asked.limit(BLOCK + 1).collect()
    if not few:
        empty = "query_id bigint, id bigint, score double, rank int"
        return corpus.sparkSession.createDataFrame([], empty)
    if len(few) <= BLOCK:
        found = _streamed(vectors, few, k, metric)
    else:
        found = _tiled(vectors, asked, asked.count(), k, metric)
    return top_k_per_group(found, ["query_id"], order, k, "id", "rank")


def centroids(df: DataFrame, group: str) -> DataFrame:
    """(id, vector): the mean vector per group, computed element by element."""
    elements = df.select(F.col(group).cast("bigint").alias("id"), F.posexplode("vector"))
    means = elements.groupBy("id", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    # One small array per group: as many elements as the vectors have.
    packed = means.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "mean"))).alias("p"))
    return packed.select("id", F.col("p.mean").alias("vector"))
