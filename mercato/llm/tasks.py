"""What the operators' tasks share: Arrow text columns, word hashes, worker caches, tree merges."""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Task functions travel with the job, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Text that one numpy step handles; bounds a task's memory whatever the batch holds.
STEP_BYTES = 2 << 20
# Bits of the filter that spares rows a shuffle; a full filter only spares less.
FILTER_BITS = 1 << 23
# Records that meet in one merge of a tree.
FAN_IN = 16


def worker_cache(owner: str, make: Callable[[], object]) -> object:
    """One object per Python worker, kept for its later tasks until another owner asks for one.

    So a worker holds what the operator at work needs and nothing of those before; bounds in bytes are
    the owner's.
    """
    kept = sys.__dict__.setdefault("_mercato_llm_kept", {})
    if owner not in kept:
        kept.clear()
        kept[owner] = make()
    return kept[owner]


class Shared:
    """A small object broadcast once, with the code of its class; the proven bound is its maker's."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self.name = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(zlib.compress(cloudpickle.dumps(value), 1))

    @property
    def value(self) -> object:
        """The object, unpacked once per task; reading it drops what other operators kept."""
        return worker_cache(self.name, lambda: cloudpickle.loads(zlib.decompress(self.packed.value)))


def slices(batch: pa.RecordBatch, text: int, most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text; a longer row comes alone."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(first, last - first)
        first = last


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x2545F4914F6CDD1D)


def _hash_piece(data: np.ndarray, offsets: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one stretch, and where they start."""
    inside = word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return np.empty(0, np.uint64), starts
    kept = np.flatnonzero(inside)
    firsts = np.searchsorted(kept, starts)
    lengths = np.diff(np.append(firsts, len(kept)))
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    place = np.arange(len(kept)) - np.repeat(firsts, lengths)
    return mix(np.add.reduceat(_BYTE[data[kept]] * powers[place], firsts)), starts


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: np.ndarray, word: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every word, index of the first word of every document and the total).

    ``lower`` maps bytes, ``word`` tells which of them belong to words; words end at documents' ends.
    """
    hashes, starts = [], []
    at = 0
    while at < len(data):
        end = min(len(data), at + STEP_BYTES)
        while end < len(data):  # go on to the end of a word
            gap = np.flatnonzero(~word[lower[data[end : end + 4096]]])
            end += int(gap[0]) if len(gap) else min(4096, len(data) - end)
            if len(gap):
                break
        inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, end)] - at
        found, places = _hash_piece(lower[data[at:end]], inner, word)
        hashes.append(found)
        starts.append(places + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def byte_tables(word_bytes: Callable[[int], bool]) -> tuple[np.ndarray, np.ndarray]:
    """(lower-casing of A-Z, which lower-cased bytes belong to words)."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return lower, np.array([word_bytes(b) for b in range(256)])


def tree_merge(df: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One record out of a column of records, merged ``FAN_IN`` at a time on the executors.

    ``merge`` must return a record of bounded size; only the last one reaches the driver.
    """
    name = df.columns[0]
    left = df.select(F.col(name).alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        for batch in batches:
            for record in batch.column(0).to_pylist():
                held.append(record)
                if len(held) >= FAN_IN:
                    held = [merge(held)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([merge(held)], pa.binary())], names=["record"])

    # Every merge follows an exchange: no task holds the worker that makes records and one that merges.
    parts = max(1, left.rdd.getNumPartitions())
    while True:
        parts = -(-parts // FAN_IN)
        left = left.repartition(parts).mapInArrow(run, "record binary")
        if parts == 1:
            break
    rows = left.collect()
    return merge([bytes(r["record"]) for r in rows]) if rows else None


def filter_bits(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def membership(df: DataFrame) -> np.ndarray:
    """A filter of fixed size over one column of longs, made as a tree: what it lacks is not in the column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            seen[filter_bits(batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64))] = True
        packed = zlib.compress(np.packbits(seen).tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["record"])

    def merge(records: list[bytes]) -> bytes:
        seen = np.zeros(FILTER_BITS // 8, np.uint8)
        for record in records:
            seen |= np.frombuffer(zlib.decompress(record), np.uint8)
        return zlib.compress(seen.tobytes(), 1)

    made = tree_merge(df.mapInArrow(run, "record binary"), merge)
    if made is None:
        return np.zeros(FILTER_BITS, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(made), np.uint8)).astype(bool)
