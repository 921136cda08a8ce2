"""Exact top-k search by inner product: tiled matrix products, partial selection, merged as a tree."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors of one shard of the corpus, and queries multiplied with it at a time.
SHARD = 8_192
QUERY_TILE = 256
CORPUS_TILE = 4_096
# Shards whose lists meet in one merge.
FAN_IN = 16
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers given as doubles; beyond the long range they are cut to it."""
    most = [np.abs(x).max(initial=0.0) for x in (queries, rows)]
    if queries.shape[1] * most[0] * most[1] < _EXACT:
        return (queries @ rows.T).astype(np.int64)
    whole = [np.array([[int(v) for v in row] for row in x], dtype=object) for x in (queries, rows)]
    products = whole[0] @ whole[1].T if queries.shape[1] else np.zeros((len(queries), len(rows)), object)
    return np.array([[max(-_LONG, min(_LONG, int(v))) for v in row] for row in products], dtype=np.int64)


def best(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with ties to the smaller id, in order."""
    if len(found) > k:
        floor = np.partition(found, len(found) - k)[len(found) - k]
        kept = np.flatnonzero(found >= floor)
        found, ids = found[kept], ids[kept]
    order = np.lexsort((ids, -found))[:k]
    return found[order], ids[order]


class _Shard:
    """Vectors of one shard and the queries that wait for it."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows: list[tuple[int, int, np.ndarray]] = []
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None

    def matrices(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self.by_width is None:
            self.by_width = {}
            for width in {len(v) for _, _, v in self.rows}:
                same = [r for r in self.rows if len(r[2]) == width]
                self.by_width[width] = (
                    np.array([r[0] for r in same]),
                    np.array([r[1] for r in same]),
                    np.array([r[2] for r in same]).reshape(len(same), width),
                )
        return self.by_width

    def answer(self, queries: list[tuple[int, int, np.ndarray]]) -> Iterator[tuple]:
        """(query row, query id, ids, scores) of the queries that have candidates here."""
        for width in {len(v) for _, _, v in queries}:
            if width not in self.matrices():
                continue
            turns, ids, matrix = self.matrices()[width]
            same = [q for q in queries if len(q[2]) == width]
            block = np.array([q[2] for q in same]).reshape(len(same), width)
            lists = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in same]
            for first in range(0, len(ids), CORPUS_TILE):
                tile = slice(first, first + CORPUS_TILE)
                products = scores(block, matrix[tile])
                for i, (turn, _, _) in enumerate(same):
                    others = turns[tile] != turn
                    near = best(products[i][others], ids[tile][others], self.k)
                    lists[i] = best(*(np.concatenate(x) for x in zip(lists[i], near, strict=True)), self.k)
            for (turn, name, _), (found, near) in zip(same, lists, strict=True):
                yield turn, name, near, found


def nearest(
    df: DataFrame, every: int = 20, k: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, key, score): the k rows of highest integer inner product per query.

    Components become floor(scale * x), x as double.  Queries are the rows whose key is divisible by
    ``every``, candidates all rows but the query's own; ties go to the smaller key.  Rows with a null key
    or vector, or a component that is null, infinite or no number, take no part; vectors meet only those
    of their length; repeated rows are rows of their own; fewer candidates give shorter lists; an empty
    table gives no rows; other columns are not read.

    The corpus lies in shards of bounded size; the queries, in blocks, are sent to every shard.
    """
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    numbers = F.transform(vector, lambda x: x.cast("double"))
    rows = df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable).select(
        F.col(key).cast("bigint").alias("id"), numbers.alias("v")
    )
    stored = scratch.materialize(rows, "vectors").withColumn("turn", F.monotonically_increasing_id())
    shards = max(1, -(-stored.count() // SHARD))
    corpus = stored.select(F.pmod(F.xxhash64("turn"), F.lit(shards)).alias("shard"), F.lit(False).alias("asks"), "turn", "id", "v")
    every_shard = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    queries = stored.filter(F.col("id") % every == 0).select(
        every_shard.alias("shard"), F.lit(True).alias("asks"), "turn", "id", "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, waiting = _Shard(k), None, []

        def answers() -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], []]
            for turn, name, near, found in shard.answer(waiting):
                for column, values in zip(out, (turn, name, number), strict=False):
                    column += [values] * len(near)
                out[3] += near.tolist()
                out[4] += found.tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], names=["turn", "query_id", "shard", "id", "score"]
            )

        for batch in batches:
            offsets = batch.column(4).offsets.to_numpy()
            flat = np.floor(np.asarray(batch.column(4).values.to_numpy(zero_copy_only=False), np.float64) * scale)
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for row, (own, asks, turn, name) in enumerate(zip(*columns, strict=True)):
                if own != number:
                    if waiting:
                        yield answers()
                    shard, number, waiting = _Shard(k), own, []
                item = (turn, name, flat[offsets[row] : offsets[row + 1]])
                if not asks:
                    shard.rows.append(item)
                    continue
                waiting.append(item)
                if len(waiting) == QUERY_TILE:
                    yield answers()
                    waiting = []
        if waiting:
            yield answers()

    # A shard's vectors come before the queries that are sent to it.
    dealt = corpus.unionByName(queries).repartition(shards, "shard").sortWithinPartitions("shard", "asks")
    found = dealt.mapInArrow(run, "turn bigint, query_id bigint, shard bigint, id bigint, score bigint")
    order = [F.desc("score"), F.asc("id")]
    while shards > FAN_IN:
        shards = -(-shards // FAN_IN)
        found = found.withColumn("shard", F.floor(F.col("shard") / FAN_IN))
        lists = Window.partitionBy("turn", "shard").orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(lists)).filter(F.col("rank") <= k).drop("rank")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("turn", "query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
