"""Shards of near-equal bytes by a histogram sort.

Rows have a place on a line of 63-bit keys.  Splitters are found by counting, over all partitions, the
exact bytes and rows below candidate keys, and probing anew between the two candidates around each
aim until one meets the tolerance; then the rows are exchanged once.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 40
# Bytes that every row has besides its text.
OVERHEAD = 16
# Candidates tried per splitter and round.
PROBES = 8
# A splitter is good when it misses its aim by at most this share of a cell.
TOLERANCE = 1 / 2_000
# Cells make up shards; one task sorts a cell.
LEAST_CELLS = 4
CELL_ROWS = 200_000
# Low bits of a key, in which rows with equal texts differ.
LOW_BITS = 24
TOP = (1 << 63) - 1


@dataclass
class Splitter:
    """What is known around one aim: keys with bytes and rows below them, the nearest on either side."""

    aim: float
    low: tuple[int, int, int]
    high: tuple[int, int, int]

    def nearest(self) -> tuple[int, int, int]:
        return min(self.low, self.high, key=lambda point: abs(point[1] - self.aim))

    def open(self, slack: float) -> bool:
        """Whether a better key may lie between."""
        return (
            abs(self.nearest()[1] - self.aim) > slack
            and self.high[0] - self.low[0] > 1
            and self.high[2] - self.low[2] > 1
        )

    def probes(self) -> list[int]:
        """Keys around where the aim would be if bytes were spread evenly, and evenly over the range."""
        low, high = self.low[0], self.high[0]
        share = (self.aim - self.low[1]) / max(1, self.high[1] - self.low[1])
        guess = low + int((high - low) * min(max(share, 0.0), 1.0))
        rows = max(1, self.high[2] - self.low[2])
        reach = max(1, int((high - low) / rows**0.5))
        found = {guess, guess - reach, guess + reach, guess - 3 * reach, guess + 3 * reach}
        found |= {low + (high - low) * i // (PROBES - 4) for i in range(1, PROBES - 4)}
        return [key for key in found if low < key < high]

    def learn(self, keys: np.ndarray, counts: Counts) -> None:
        """Takes the counted keys around the aim, moved up to the rows that lie between them."""
        at = int(np.searchsorted(counts.size, self.aim))
        if at > 0 and keys[at - 1] > self.low[0]:
            self.low = (int(keys[at - 1]), int(counts.size[at - 1]), int(counts.rows[at - 1]))
        if at < len(keys) and keys[at] < self.high[0]:
            self.high = (int(keys[at]), int(counts.size[at]), int(counts.rows[at]))
        if counts.least[at] <= counts.most[at]:
            self.low = (max(self.low[0], int(counts.least[at])), *self.low[1:])
            self.high = (min(self.high[0], int(counts.most[at]) + 1), *self.high[1:])


@dataclass
class Counts:
    """Exact bytes and rows below each key, and the first and last row between one key and the next."""

    size: np.ndarray
    rows: np.ndarray
    least: np.ndarray
    most: np.ndarray


def _below(stored: DataFrame, keys: np.ndarray) -> Counts:
    """One pass: every task sends one row per interval that it has rows in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(keys) + 1, np.int64), np.zeros(len(keys) + 1, np.int64)
        least, most = np.full(len(keys) + 1, TOP), np.full(len(keys) + 1, -1)
        for batch in batches:
            places, sizes = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cells = np.searchsorted(keys, places, side="right")
            np.add.at(size, cells, sizes)
            np.minimum.at(least, cells, places)
            np.maximum.at(most, cells, places)
            rows += np.bincount(cells, minlength=len(keys) + 1)
        cells = np.flatnonzero(rows)
        arrays = [pa.array(cells), *(pa.array(x[cells]) for x in (size, rows, least, most))]
        yield pa.RecordBatch.from_arrays(arrays, names=["cell", "size", "rows", "least", "most"])

    shape = "cell bigint, size bigint, rows bigint, least bigint, most bigint"
    found = stored.select("place", "size").mapInArrow(run, shape).groupBy("cell")
    counts = Counts(*(np.full(len(keys) + 1, x, np.int64) for x in (0, 0, TOP, -1)))
    for r in found.agg(F.sum("size"), F.sum("rows"), F.min("least"), F.max("most")).collect():
        cell = r[0]
        counts.size[cell], counts.rows[cell], counts.least[cell], counts.most[cell] = r[1:]
    counts.size, counts.rows = np.cumsum(counts.size)[:-1], np.cumsum(counts.rows)[:-1]
    return counts


def splitters(stored: DataFrame, cells: int, total: int, count: int) -> list[tuple[int, int, int]]:
    """(key, bytes below, rows below) of the borders between ``cells`` cells of near-equal bytes."""
    slack = total / cells * TOLERANCE
    wanted = [Splitter(total * i / cells, (0, 0, 0), (TOP, total, count)) for i in range(1, cells)]
    while keys := sorted({key for s in wanted if s.open(slack) for key in s.probes()}):
        probed = np.array(keys, dtype=np.int64)
        counts = _below(stored, probed)
        for s in wanted:
            if s.open(slack):
                s.learn(probed, counts)
    return [s.nearest() for s in wanted]


def sharded(df: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(key, text, size, text_crc32, shard, slot) of every row, in shards of near-equal bytes.

    A row's size is its text's UTF-8 bytes and 16.  Keys on the line come from hashes, of the text in the
    high bits and of the row in the low ones: equal texts are neighbours, and even a group larger than a
    shard is split.  Slots number a shard's rows without gaps.  Null texts have no bytes and crc32 0; null
    keys and repeated rows are placed like others; an empty table gives no rows; other columns are not read.
    """
    size = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("bigint") + OVERHEAD
    low = (1 << LOW_BITS) - 1
    place = (
        F.xxhash64(text).bitwiseAND(F.lit(TOP ^ low)).bitwiseOR(F.xxhash64(key, "turn").bitwiseAND(F.lit(low)))
    )
    # The table is stored first: rows must keep their keys in every later pass.
    stored = scratch.materialize(
        df.select(F.col(key), F.col(text).cast("string").alias(text))
        .withColumn("turn", F.monotonically_increasing_id())
        .withColumns({"size": size, "text_crc32": F.coalesce(F.crc32(text), F.lit(0)).cast("bigint"), "place": place})
        .drop("turn"),
        "placed",
    )
    total, count = stored.agg(F.sum("size"), F.count("*")).first()
    cells = shards * max(LEAST_CELLS, -(-count // (shards * CELL_ROWS)))
    borders = splitters(stored, cells, total or 0, count)
    keys = np.array([b[0] for b in borders], dtype=np.int64)
    before = np.array([0, *(b[2] for b in borders)], dtype=np.int64)
    per_shard = cells // shards
    # Rows of the shard before each cell.
    offsets = before - np.repeat(before[::per_shard], per_shard)
    names = [key, text, "size", "text_crc32", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.searchsorted(keys, batch.column(0).to_numpy(zero_copy_only=False), side="right")
            arrays = [pa.array(cell.astype(np.int32)), pa.array(offsets[cell])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*kept, "cell", "offset"])

    kept = ["place", *[n for n in names if n != "place"]]
    kinds = ", ".join(f"`{n}` {stored.schema[n].dataType.simpleString()}" for n in kept)
    dealt = stored.select(*kept).mapInArrow(run, f"{kinds}, cell int, offset bigint")
    turn = F.row_number().over(Window.partitionBy("cell").orderBy("place", key))
    return dealt.withColumn("turn", turn).select(
        key,
        text,
        "size",
        "text_crc32",
        F.floor(F.col("cell") / per_shard).cast("int").alias("shard"),
        (F.col("offset") + F.col("turn") - 1).cast("bigint").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> None:
    """The rows as one folder per shard below ``path``."""
    sharded(df, key, text, shards).write.partitionBy("shard").parquet(path)
