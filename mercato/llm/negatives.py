"""Hard negatives by rotated one-bit codes: intervals around popcount estimates spare most products.

Every vector is rotated (sign flips and Hadamard transforms) and written as signs with the alignment of
vector and signs; what the signs leave over is coded the same way, a few times.  An inner product is the
sum of alignment times signs times query, which popcounts give for a query in whole steps, and at most
the product of both remainders' lengths off (Cauchy and Schwarz).  Rows whose interval cannot reach a
list are left out; the others are scored in whole numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# One-bit codes per vector, each of what the one before leaves over, and bits of a query's steps.
LEVELS = 4
QUERY_BITS = 6
# Bytes of one block of rows and of one tile of anchors, and cells compared at a time.
BLOCK_BYTES, TILE_BYTES = 1 << 20, 4 << 20
CELLS = 1 << 19
# Groups of blocks that a tile's lists are made from, merged after one exchange.
SPREAD = 32
SEED = 20_240_229
# How stored vectors are written: the first kind that holds them.
KINDS = (np.int16, np.int32, np.float64)
# Whole numbers that doubles hold exactly.
_EXACT = 1 << 53
# What rounding of doubles may add, against the product of two lengths.
_ROUNDING = 1e-9


def rotated(vectors: np.ndarray) -> np.ndarray:
    """The vectors, filled up to a power of two of at least 64 components, under one fixed rotation."""
    width = 64
    while width < vectors.shape[1]:
        width *= 2
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    rng = np.random.default_rng(SEED)
    for _ in range(3):
        out *= rng.choice((-1.0, 1.0), width)
        step = 1
        while step < width:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), width)
            step *= 2
        out /= np.sqrt(width)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """``LEVELS`` sign codes per vector, their alignments, and the length of what they leave over."""

    signs: np.ndarray  # level, row, word
    along: np.ndarray  # level, row
    rest: np.ndarray
    length: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray) -> Codes:
        left = rotated(vectors)
        length = np.sqrt((left * left).sum(1))
        signs, along = [], []
        for _ in range(LEVELS):
            positive = left > 0
            ones = np.where(positive, 1.0, -1.0)
            share = (left * ones).sum(1) / left.shape[1]
            signs.append(_packed(positive))
            along.append(share)
            left = left - share[:, None] * ones
        return cls(np.array(signs), np.array(along), np.sqrt((left * left).sum(1)), length)


class Queries:
    """Anchors in whole steps, their bits in planes that popcounts combine with codes."""

    def __init__(self, vectors: np.ndarray) -> None:
        turned = rotated(vectors)
        self.width = turned.shape[1]
        self.length = np.sqrt((turned * turned).sum(1))
        self.low = turned.min(1)
        self.step = (turned.max(1) - self.low) / ((1 << QUERY_BITS) - 1)
        safe = np.where(self.step > 0, self.step, 1.0)
        steps = np.rint((turned - self.low[:, None]) / safe[:, None]).astype(np.int64)
        # No sign code can make more of the rounding than the sum of its parts.
        self.off = np.abs(turned - self.low[:, None] - steps * self.step[:, None]).sum(1)
        self.total = steps.sum(1)
        self.planes = np.array([_packed((steps >> bit & 1).astype(bool)) for bit in range(QUERY_BITS)])

    def intervals(self, rows: slice, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(low, high): between them lie the inner products of these anchors with every coded row."""
        shape = len(self.low[rows]), codes.signs.shape[1]
        steps, ones = np.zeros(shape), np.zeros(shape[1])
        for signs, along in zip(codes.signs, codes.along, strict=True):
            hits = np.zeros(shape, np.int32)
            for plane in self.planes[::-1, rows]:
                hits <<= 1
                for word in range(signs.shape[1]):
                    hits += np.bitwise_count(plane[:, word, None] & signs[None, :, word])
            steps += along * hits
            ones += along * (2 * np.bitwise_count(signs).sum(1, dtype=np.int64) - self.width)
        # A query's part is its lowest value plus steps; signs count ones twice and then take all off.
        step = self.step[rows, None]
        middle = 2 * step * steps
        middle -= step * self.total[rows, None] * codes.along.sum(0)
        middle += self.low[rows, None] * ones
        wide = self.off[rows, None] * np.abs(codes.along).sum(0)
        wide += self.length[rows, None] * (codes.rest + _ROUNDING * codes.length) + 1e-6
        return middle - wide, middle + wide


@dataclass
class Block:
    """Rows of one width: their places, ids, labels, whole-number vectors and their stored codes."""

    turns: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    codes: Codes

    @classmethod
    def of(cls, turns: tuple, ids: tuple, labels: tuple, vectors: np.ndarray) -> Block:
        return cls(*(np.array(c, np.int64) for c in (turns, ids, labels)), vectors, Codes.of(vectors))

    def pack(self) -> bytes:
        codes = self.codes
        most = np.abs(self.vectors).max(initial=0.0)
        kind = next((k for k in KINDS if np.dtype(k).kind == "i" and most <= np.iinfo(k).max), np.float64)
        head = [len(self.ids), self.vectors.shape[1], codes.signs.shape[2], KINDS.index(kind)]
        parts = [np.array(head, np.int64), self.turns, self.ids, self.labels]
        parts += [codes.signs, codes.along, codes.rest, codes.length, self.vectors.astype(kind)]
        return b"".join([p.tobytes() for p in parts])

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        size, width, words, kind = np.frombuffer(data, np.int64, 4).tolist()
        at = 32

        def part(kind: type, *shape: int) -> np.ndarray:
            nonlocal at
            count = int(np.prod(shape))
            found = np.frombuffer(data, kind, count, at) if count else np.empty(0, kind)
            at += found.nbytes
            return found.reshape(shape)

        heads = [part(np.int64, size) for _ in range(3)]
        codes = Codes(
            part(np.uint64, LEVELS, size, words),
            part(np.float64, LEVELS, size),
            part(np.float64, size),
            part(np.float64, size),
        )
        return cls(*heads, part(KINDS[kind], size, width).astype(np.float64), codes)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products, row by row, of whole numbers given as doubles."""
    if a.shape[1] * np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    whole = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array(whole, dtype=object)


def first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, turns: np.ndarray, k: int) -> np.ndarray:
    """Places of every group's k highest scores, ties to the smaller id."""
    order = np.lexsort((turns, ids, -score, group)) if score.dtype != object else np.array(
        sorted(range(len(score)), key=lambda i: (group[i], -score[i], ids[i], turns[i])), np.int64
    )
    sorted_group = group[order]
    starts = np.searchsorted(sorted_group, sorted_group)
    return order[np.arange(len(order)) - starts < k]


def _largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of every row; minus infinity where a row has fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


class Tile:
    """Anchors and the lists that blocks of rows have filled so far."""

    def __init__(self, block: Block, k: int) -> None:
        self.block, self.k = block, k
        self.queries = Queries(block.vectors)
        # One list per slot: anchor, score, id, turn.
        self.slot = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.turns = np.empty(0, np.int64)

    def slots(self) -> int:
        return len(self.block.ids)

    def floor(self) -> np.ndarray:
        """The k-th score of every full list: what a row must reach."""
        full = np.full(self.slots(), -np.inf)
        if len(self.slot):
            names, counts = np.unique(self.slot, return_counts=True)
            ends = np.cumsum(counts) - 1
            # A double may round a long score up; the row that ties must still come in.
            last = np.nextafter(self.score[ends].astype(np.float64), -np.inf)
            full[names[counts == self.k]] = last[counts == self.k]
        return full

    def take(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, turns: np.ndarray) -> None:
        parts = [(self.slot, slot), (self.score, score), (self.ids, ids), (self.turns, turns)]
        joined = [np.concatenate(p) for p in parts]
        kept = first(*joined, self.k)
        self.slot, self.score, self.ids, self.turns = (x[kept] for x in joined)

    def meet(self, rows: Block) -> int:
        """Adds what a block holds for these anchors; returns the number of products it took."""
        step, scored = max(1, CELLS // len(rows.ids)), 0
        for start in range(0, len(self.block.ids), step):
            anchors = slice(start, start + step)
            at, to = np.nonzero(self.chosen(anchors, *self.queries.intervals(anchors, rows.codes), rows))
            for part in range(0, len(at), CELLS):
                some = slice(part, part + CELLS)
                anchor = at[some] + start
                self.fill(anchor, to[some], products(self.block.vectors[anchor], rows.vectors[to[some]]), rows)
            scored += len(at)
        return scored


class Positives(Tile):
    """The first rows of the anchor's label."""

    def chosen(self, anchors: slice, low: np.ndarray, high: np.ndarray, rows: Block) -> np.ndarray:
        fits = self.block.labels[anchors, None] == rows.labels[None, :]
        fits &= self.block.turns[anchors, None] != rows.turns[None, :]
        floor = self.floor()[anchors]
        if np.isneginf(floor).any():
            floor = np.maximum(_largest(np.where(fits, low, -np.inf), self.k), floor)
        return fits & (high >= floor[:, None])

    def fill(self, at: np.ndarray, to: np.ndarray, scores: np.ndarray, rows: Block) -> None:
        self.take(at, scores, rows.ids[to], rows.turns[to])


class Negatives(Tile):
    """The first rows of other labels between two bounds, per bound of the anchor."""

    def __init__(self, block: Block, k: int, bounds: list[list[tuple[int, int]]]) -> None:
        super().__init__(block, k)
        self.most = max(map(len, bounds))
        # Lists that are not asked for end below where they start.
        self.low = [[b[p][0] if p < len(b) else 1 for b in bounds] for p in range(self.most)]
        self.high = [[b[p][1] if p < len(b) else 0 for b in bounds] for p in range(self.most)]

    def slots(self) -> int:
        return self.most * len(self.block.ids)

    def _between(self, p: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds as doubles, rounded outward."""
        low = np.nextafter(np.array(self.low[p], np.float64), -np.inf)
        high = np.nextafter(np.array(self.high[p], np.float64), np.inf)
        asked = np.array([a <= b for a, b in zip(self.low[p], self.high[p], strict=True)], bool)
        return np.where(asked, low, np.inf), np.where(asked, high, -np.inf)

    def chosen(self, anchors: slice, low: np.ndarray, high: np.ndarray, rows: Block) -> np.ndarray:
        other = self.block.labels[anchors, None] != rows.labels[None, :]
        floors = self.floor().reshape(self.most, -1)
        found = np.zeros(other.shape, bool)
        for p in range(self.most):
            least, most = (b[anchors, None] for b in self._between(p))
            floor = floors[p][anchors]
            if np.isneginf(floor).any():
                # Rows that are surely between the bounds tell what others must reach.
                sure = other & (low > least) & (high < most)
                floor = np.maximum(_largest(np.where(sure, low, -np.inf), self.k), floor)
            found |= other & (low <= most) & (high >= np.maximum(least, floor[:, None]))
        return found

    def fill(self, at: np.ndarray, to: np.ndarray, scores: np.ndarray, rows: Block) -> None:
        kind = object if scores.dtype == object else np.int64
        for p in range(self.most):
            low, high = np.array(self.low[p], dtype=kind), np.array(self.high[p], dtype=kind)
            kept = np.flatnonzero((scores >= low[at]) & (scores <= high[at]))
            slot = at[kept] + p * len(self.block.ids)
            self.take(slot, scores[kept], rows.ids[to[kept]], rows.turns[to[kept]])


def usable_rows(df: DataFrame, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """(turn, id, label, v): rows that take part, stored once, with vectors of whole numbers."""

    def sound(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))

    name = F.col(key).cast("bigint")
    given = F.col(label).cast("bigint")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("double"))
    rows = df.filter(
        F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, sound)
    ).select(
        F.monotonically_increasing_id().alias("turn"), name.alias("id"), F.when(name % 7 == 0, (given + 1) % 10).otherwise(given).alias("label"), whole.alias("v")
    )
    return scratch.materialize(rows, "vectors")


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows as packed blocks of one width and about ``most`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def out(width: int) -> pa.RecordBatch:
            turns, ids, labels, vectors = zip(*held.pop(width), strict=True)
            block = Block.of(turns, ids, labels, np.array(vectors, np.float64).reshape(len(ids), width))
            return pa.RecordBatch.from_arrays([pa.array([block.pack()], pa.binary())], names=["block"])

        for batch in batches:
            offsets = batch.column(3).offsets.to_numpy()
            flat = batch.column(3).values.to_numpy(zero_copy_only=False)
            heads = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            for row, head in enumerate(heads):
                vector = flat[offsets[row] : offsets[row + 1]]
                held.setdefault(len(vector), []).append((*head, vector))
                if len(held[len(vector)]) * (8 * len(vector) + 24) >= most:
                    yield out(len(vector))
        for width in list(held):
            yield out(width)

    return rows.mapInArrow(run, "block binary")


def _bounds(scores: list[int], least: int, most: int) -> list[tuple[int, int]]:
    """The whole numbers n with least * score <= 100 * n <= most * score."""
    return [(-(-least * s // 100), most * s // 100) for s in scores]


def hard_negatives(
    df: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), labels of rows whose key is divisible by 7 the next of ten.
    Anchors are the rows whose key is divisible by ``every``; their positives the first rows of their
    label, their negatives the first rows of another label whose score is between ``least`` and ``most``
    hundredths of the positive's.  Higher inner products come first, ties to the smaller key.

    Rows with a null key, label or vector, or a component that is null, infinite or no number, take no
    part.  Repeated rows are rows of their own, not each other's self.  Vectors meet those of their
    length.  An anchor without positives, or a positive without negatives, has no row; an empty table
    gives none; other columns are not read.  Scores beyond the range of long raise.

    Blocks of rows pass tiles of anchors twice, for the positives and then for what lies below them.
    Every tile's blocks are dealt to ``SPREAD`` tasks, each of which sends on one short list per anchor.
    """
    rows = usable_rows(df, key, vector, label, scale)
    # Small files are read together, so that blocks are full; anchors gather in tiles, dealt row by row.
    size = F.sum(F.size("v") * 8 + 24).cast("bigint")
    asking = F.col("id") % every == 0
    sums = rows.agg(size.alias("all"), F.sum(F.when(asking, F.size("v") * 8 + 24)).cast("bigint").alias("anchors")).first()
    numbered = _blocks(rows.coalesce(max(1, (sums["all"] or 0) // BLOCK_BYTES)), BLOCK_BYTES).withColumn(
        "n", F.monotonically_increasing_id()
    )
    blocks = scratch.materialize(numbered, "blocks")
    anchors = rows.filter(asking).repartition(max(1, -(-(sums["anchors"] or 0) // TILE_BYTES)))
    tiles = scratch.materialize(_blocks(anchors, TILE_BYTES).withColumn("tile", F.monotonically_increasing_id()), "tiles")
    names = [r["tile"] for r in tiles.select("tile").collect()]
    lists = _lists(blocks, tiles, names, None, lambda tile, asked: Positives(tile, positives))
    near = scratch.materialize(_merged(lists, positives).drop("slot"), "positives")

    def below(tile: Block, asked: list[list[int]]) -> Negatives:
        return Negatives(tile, negatives, [_bounds(scores, least, most) for scores in asked])

    wanted = near.groupBy("anchor", "tile").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores")
    )
    found = _merged(_lists(blocks, tiles, names, wanted, below), negatives)
    pairs = near.select(
        "anchor",
        (F.col("place") - 1).alias("slot"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return pairs.join(found.drop("turn", "tile"), ["anchor", "slot"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


LISTS = "tile bigint, anchor bigint, anchor_id bigint, slot int, id bigint, turn bigint, score bigint"


ASKED = "array<struct<anchor:bigint,scores:array<bigint>>>"


def _lists(
    blocks: DataFrame,
    tiles: DataFrame,
    names: list[int],
    wanted: DataFrame | None,
    make: Callable[[Block, list[list[int]]], Tile],
) -> DataFrame:
    """Every cell of tiles and groups of blocks: the lists its blocks give the tile's anchors.

    ``wanted`` has the scores of each anchor's positives; tiles without any are left out.
    """
    asked = F.lit(None).cast(ASKED) if wanted is None else F.col("asked")
    if wanted is not None:
        packed = wanted.groupBy("tile").agg(F.collect_list(F.struct("anchor", "scores")).alias("asked"))
        tiles = tiles.join(packed, "tile")
    groups = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    asking = tiles.select("tile", groups.alias("part"), F.lit(-1).cast("bigint").alias("n"), "block", asked.alias("asked"))
    every_tile = F.explode(F.lit(names).cast("array<bigint>"))
    passing = blocks.select(
        every_tile.alias("tile"),
        # The number of the block's task and its place there: neighbours go to different tasks.
        F.pmod(F.shiftright("n", 33) + F.col("n").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(SPREAD)).cast("int").alias("part"),
        "n",
        "block",
        F.lit(None).cast(ASKED).alias("asked"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile: Tile | None = None
        cell = None

        def out() -> Iterator[pa.RecordBatch]:
            if tile is not None and len(tile.slot):
                size = len(tile.block.ids)
                at = tile.slot % size
                columns = [np.full(len(at), cell[0]), tile.block.turns[at], tile.block.ids[at], tile.slot // size]
                arrays = [pa.array(c.tolist(), pa.int64()) for c in (*columns, tile.ids, tile.turns, tile.score)]
                arrays[3] = arrays[3].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in LISTS.split(", ")])

        for batch in batches:
            for name, part, n, data, scores in zip(*(batch.column(i) for i in range(5)), strict=True):
                here = name.as_py(), part.as_py()
                if n.as_py() < 0:
                    yield from out()
                    tile, cell = None, here
                    block = Block.unpack(data.as_py())
                    by_anchor = {a["anchor"]: a["scores"] for a in scores.as_py() or []}
                    tile = make(block, [by_anchor.get(t, []) for t in block.turns.tolist()])
                elif tile is not None and here == cell:
                    rows = Block.unpack(data.as_py())
                    if rows.vectors.shape[1] == tile.block.vectors.shape[1]:
                        tile.meet(rows)
        yield from out()

    cells = asking.unionByName(passing)
    parts = max(1, len(names) * SPREAD)
    dealt = cells.repartition(parts, "tile", "part").sortWithinPartitions("tile", "part", "n")
    return dealt.mapInArrow(run, LISTS)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list per anchor and slot, numbered from 1 in ``place``."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc("id"), F.asc("turn"))
    return lists.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
