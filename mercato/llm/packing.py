"""Best-fit packing of token sequences with a swap-based local search."""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.llm import codec, tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pieces packed together by one task.
BLOCK = 8_192
# Share of its sequences that a round must save for another one to follow.
SAVING = 0.001
PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = f"{PIECES}, row bigint, bin int, offset bigint, underfull boolean"


def token_pieces(
    df: DataFrame, vocabulary: str, key: str, text: str, capacity: int, end_id: int
) -> DataFrame:
    """(key, piece, start, length, ids_crc32): documents longer than ``capacity`` are cut."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def fresh() -> codec.Codec:
        return codec.Codec(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tasks.worker_cache(f"ids {vocabulary}", fresh)
        for batch in batches:
            for part in tasks.slices(batch, 1):
                rows, numbers, starts, lengths, sums = [], [], [], [], []
                for row, ids in enumerate(coder.encode(part.column(1).to_pylist())):
                    ids += end
                    size = len(ids) // 4
                    at = 0
                    while at < size:
                        # Only the first piece may be shorter.
                        length = (size - at) % capacity or capacity
                        rows.append(row)
                        numbers.append(0 if at == 0 else numbers[-1] + 1)
                        starts.append(at)
                        lengths.append(length)
                        sums.append(zlib.crc32(ids[4 * at : 4 * (at + length)]))
                        at += length
                keys = part.column(0).take(pa.array(rows, pa.int64()))
                columns = [keys, pa.array(numbers, pa.int32())]
                columns += [pa.array(c, pa.int64()) for c in (starts, lengths, sums)]
                names = [key, "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key), F.col(text).cast("string").alias(f"{key} text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, {PIECES}")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Items, largest first, each into the bin that it leaves fullest."""
    bins: list[list[int]] = []
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_gaps = 0  # bit g: some bin has a gap of g
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            number = waiting[gap].pop()
            if not waiting[gap]:
                open_gaps &= ~(1 << gap)
        else:
            gap, number = capacity, len(bins)
            bins.append([])
        bins[number].append(item)
        if gap > size:
            waiting[gap - size].append(number)
            open_gaps |= 1 << (gap - size)
    return bins


def _pairs(items: list[int], sizes: list[int]) -> dict[int, tuple[int, int]]:
    """Every sum that two of a bin's items have, with one pair that has it."""
    by_size: dict[int, list[int]] = {}
    for i in items:
        by_size.setdefault(sizes[i], []).append(i)
    found: dict[int, tuple[int, int]] = {}
    kinds = list(by_size.items())
    for n, (size, same) in enumerate(kinds):
        if len(same) > 1:
            found.setdefault(2 * size, (same[0], same[1]))
        for other, more in kinds[n + 1 :]:
            found.setdefault(size + other, (same[0], more[0]))
    return found


class _Offers:
    """Which bins can give an amount: one document of that size, or two that sum to it."""

    def __init__(self, capacity: int) -> None:
        self.bins: list[dict[int, tuple]] = [{} for _ in range(capacity + 1)]
        self.amounts = 0  # bit a: some bin gives a

    def add(self, number: int, amounts: dict[int, tuple]) -> None:
        for amount, items in amounts.items():
            self.bins[amount][number] = items
            self.amounts |= 1 << amount

    def drop(self, number: int, amounts: dict[int, tuple]) -> None:
        for amount in amounts:
            del self.bins[amount][number]
            if not self.bins[amount]:
                self.amounts &= ~(1 << amount)


class _Search:
    """Underfull bins and everything they could give each other, indexed by size."""

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int) -> None:
        self.bins, self.sizes, self.capacity = bins, sizes, capacity
        self.fills = [sum(sizes[i] for i in items) for items in bins]
        self.single, self.pair = _Offers(capacity), _Offers(capacity)
        self.own: list[tuple[dict, dict]] = [({}, {})] * len(bins)
        # Documents that would have to move to fill all bins but the last.
        self.slack = sum(capacity - f for f in self.fills)
        for number in range(len(bins)):
            self._enter(number)

    def _enter(self, number: int) -> None:
        """Lists what a bin gives; full and empty bins give nothing."""
        items, single, pair = self.bins[number], {}, {}
        if 0 < self.fills[number] < self.capacity:
            single = {self.sizes[i]: (i,) for i in items}
            pair = _pairs(items, self.sizes)
        self.single.add(number, single)
        self.pair.add(number, pair)
        self.own[number] = single, pair

    def _leave(self, number: int) -> None:
        single, pair = self.own[number]
        self.single.drop(number, single)
        self.pair.drop(number, pair)

    def _best(self, target: int, offers: _Offers, given: int, floor: int) -> tuple[int, int, tuple] | None:
        """(gain, source, documents) of the most above ``floor`` that the target could take for ``given``."""
        fill, most = self.fills[target], self.capacity - self.fills[target]
        amounts = offers.amounts & ((2 << (given + most)) - 1)
        while amounts.bit_length() > given + floor + 1:
            amount = amounts.bit_length() - 1
            gain = amount - given
            for source, items in offers.bins[amount].items():
                # Squared fill rises when the target ends fuller than the source was.
                if source != target and self.fills[source] < fill + gain:
                    return gain, source, items
            amounts &= ~(1 << amount)
        return None

    def improve(self, target: int) -> bool:
        """Makes the exchange that fills the target best, if one raises squared fill."""
        most = self.capacity - self.fills[target]
        single, pair = self.own[target]
        best: tuple[int, int, tuple, tuple] | None = None
        # Nothing or one document for one or two, two documents for one.
        ways = [((), 0, True)]
        ways += [(items, size, True) for size, items in single.items()]
        ways += [(items, size, False) for size, items in pair.items()]
        for give, given, two in ways:
            for offers in (self.single, self.pair) if two else (self.single,):
                found = self._best(target, offers, given, best[0] if best else 0)
                if found:
                    best = (*found, give)
                    if best[0] == most:
                        break
            if best and best[0] == most:
                break
        if not best:
            return False
        gain, source, take, give = best
        for number, out, into in ((target, give, take), (source, take, give)):
            self._leave(number)
            self.bins[number] = [i for i in self.bins[number] if i not in out] + list(into)
        self.fills[target] += gain
        self.fills[source] -= gain
        for number in (target, source):
            self._enter(number)
        if not self.fills[source]:
            self.slack -= self.capacity
        return True

    def run(self) -> None:
        """Exchanges until none raises squared fill, or until no bin can be saved any more."""
        moved = True
        while moved and self.slack >= self.capacity:
            moved = False
            for target in sorted(range(len(self.bins)), key=lambda b: (-self.fills[b], b)):
                while 0 < self.fills[target] < self.capacity and self.improve(target):
                    moved = True
                    if self.slack < self.capacity:
                        return


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins after exchanges among all underfull ones, emptied bins left out.

    Each exchange raises the sum of squared fills, a whole number that is bounded, so the search ends: at
    bins between which no exchange raises it, or as few bins as their fills allow.  Searching the result
    again changes nothing.
    """
    search = _Search([list(items) for items in bins], sizes, capacity)
    search.run()
    return [items for items in search.bins if items]


def _place(table: pa.Table, key: str, capacity: int, slack: int) -> pa.Table:
    """One block's pieces with bin, offset and whether the bin is worth another round."""
    sizes = table.column("length").to_pylist()
    bins = local_search(best_fit(sizes, capacity), sizes, capacity)
    numbers, offsets = np.zeros(len(sizes), np.int32), np.zeros(len(sizes), np.int64)
    underfull = np.zeros(len(sizes), bool)
    for number, items in enumerate(bins):
        at = 0
        for item in sorted(items):
            numbers[item], offsets[item] = number, at
            at += sizes[item]
        underfull[items] = capacity - at > slack
    kept = table.select([key, "piece", "start", "length", "ids_crc32", "row"])
    kept = kept.append_column("bin", pa.array(numbers)).append_column("offset", pa.array(offsets))
    return kept.append_column("underfull", pa.array(underfull))


def pack(
    df: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2_048,
    end_id: int = 0,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset): every token of every row placed once.

    A row's ids are those of its whole text and then ``end_id``; null and empty texts have that id
    alone.  Rows longer than ``capacity`` are cut, the first piece may be shorter.  Repeated rows and
    null keys are packed like any others; an empty table gives no rows; other columns are not read.

    Blocks of pieces are packed best-fit with exchanges between all of their underfull bins.  What lies
    in bins that stay underfull is dealt and packed anew, round after round, until one block has held
    them all or a round saves less than ``SAVING`` of its sequences.
    """
    spark = df.sparkSession
    cut = scratch.materialize(token_pieces(df, vocabulary, key, text, capacity, end_id), "pieces")
    numbered = cut.withColumn("row", F.monotonically_increasing_id())
    names = [key, "piece", "start", "length", "ids_crc32"]
    placed = [
        numbered.filter(F.col("length") == capacity).select(
            *names, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
        )
    ]
    left = numbered.filter(F.col("length") < capacity)
    kind = df.schema[key].dataType.simpleString()
    count, turn = left.count(), 0
    earlier, sequences = None, None
    while count:
        blocks = -(-count // BLOCK)
        slack = capacity // 64 if blocks > 1 else capacity
        packed = (
            left.withColumn("block", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(blocks)))
            .groupBy("block")
            .applyInArrow(_placer(key, capacity, slack), f"block bigint, `{key}` {kind}, {PLACED}")
        )
        stored = scratch.materialize(packed, "packed")
        number = F.lit(turn << 56) + F.shiftleft(F.col("block"), 20) + F.col("bin")
        numbers = stored.withColumn("sequence_id", number)
        sums = stored.filter("offset = 0").agg(F.count("*"), F.sum(F.col("underfull").cast("bigint"))).first()
        if sequences is not None and sums[0] > sequences * (1 - SAVING):
            # Nothing is won by dealing again: the better of both packings stays.
            placed.append((numbers if sums[0] < sequences else earlier).select(*names, "sequence_id", "offset"))
            break
        last = blocks == 1 or not sums[1]
        placed.append((numbers if last else numbers.filter("NOT underfull")).select(*names, "sequence_id", "offset"))
        if last:
            break
        earlier, sequences = numbers.filter("underfull"), sums[1]
        left, turn = earlier.select(*names, "row"), turn + 1
        count = left.count()
    return reduce(DataFrame.unionByName, placed)


def _placer(key: str, capacity: int, slack: int):
    def run(group: tuple, table: pa.Table) -> pa.Table:
        placed = _place(table, key, capacity, slack)
        block = pa.array(np.full(placed.num_rows, group[0].as_py(), np.int64))
        return placed.add_column(0, "block", block)

    return run
