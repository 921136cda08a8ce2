"""Order-preserving packing: windows of a token stream, cut by dynamic programming where texts pause.

The documents of a partition, in their order, are one stream.  It is cut at ends of documents (free),
ends of sentences and, in long sentences, every few tokens (both at a penalty), so that padding and
penalties together are least.  The best cut before a place lies at most one window back: a monotone
queue holds the candidates, since padding grows with the distance; windows whose length is a power of
two need no padding and are looked up one by one.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm import codec, tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tokens that are cut together; the last window of a block is cut again with the next one.
BLOCK = 1 << 18
# Sentences of more tokens than the first may also be cut at every so many tokens.
LONG, STRIDE = 64, 16
# Tokens of padding that a cut at the end of a sentence, one inside a sentence, or one more sequence is worth.
SENTENCE, INSIDE, SEQUENCE = 4, 32, 256
# What ends a sentence, and what may follow that before the next one.
ENDS = ".!?…。！？"
WIDE_ENDS = "。！？"
CLOSERS = "\"')]}”’»"


def best_cuts(places: np.ndarray, penalties: np.ndarray, capacity: int, last: bool = True) -> list[int]:
    """The places, in order, at which windows end, at the least padding plus penalties plus ``SEQUENCE`` each.

    ``places`` ascend from above 0, at most ``capacity`` apart.  With ``last`` the final window ends at
    the last place; otherwise at whichever place of the last window's reach is cheapest so far.
    A window is padded to ``capacity`` unless its length is a power of two.
    """
    of, start_of = _unpadded(places, capacity)
    at = [0, *places.tolist()]
    cost, before = [0] * len(at), [0] * len(at)
    # Candidates in order of place, their keys ascending: cost plus place.
    queue, reach, keys, head, pair = [0], [0], [0], 0, 0
    for number, (place, penalty) in enumerate(zip(at[1:], penalties.tolist(), strict=True), 1):
        limit = place - capacity
        while reach[head] < limit:
            head += 1
        start = queue[head]
        least = keys[head] - limit
        while of[pair] == number:
            other = start_of[pair]
            if cost[other] <= least:
                least, start = cost[other], other
            pair += 1
        least += penalty + SEQUENCE
        cost[number], before[number] = least, start
        key = least + place
        while keys[-1] >= key and len(keys) > head:
            del keys[-1], queue[-1], reach[-1]
            if not keys:
                break
        keys.append(key)
        queue.append(number)
        reach.append(place)
    end = len(at) - 1
    if not last:
        near = range(int(np.searchsorted(places, at[-1] - capacity, side="right")) + 1, len(at))
        end = min(near, key=lambda n: (cost[n], -n))
    cuts = []
    while end:
        cuts.append(at[end])
        end = before[end]
    return cuts[::-1]


def _unpadded(places: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """(number of a place, number of one a power of two before it) of all such windows, in order."""
    at = np.concatenate([[0], places])
    number = np.full(int(at[-1]) + 1, -1, np.int64)
    number[at] = np.arange(len(at))
    ends, starts = [], []
    for power in range(capacity.bit_length()):
        size = 1 << power
        if size <= capacity:
            far = np.flatnonzero(at >= size)
            found = number[at[far] - size]
            ends.append(far[found >= 0])
            starts.append(found[found >= 0])
    of, start = np.concatenate(ends), np.concatenate(starts)
    order = np.argsort(of, kind="stable")
    return [*of[order].tolist(), -1], start[order].tolist()


class Pauses:
    """Where the texts of a vocabulary's ids pause."""

    def __init__(self, tokens: list[bytes]) -> None:
        texts = [t.decode("utf-8", "replace") for t in tokens]
        bare = [t.rstrip(CLOSERS) for t in texts]
        self.ends = np.array([b.endswith(tuple(ENDS)) for b in bare])
        self.wide = np.array([b.endswith(tuple(WIDE_ENDS)) for b in bare])
        self.closes = np.array([bool(t) and not b for t, b in zip(texts, bare, strict=True)])
        self.line = np.array([t.endswith("\n") for t in texts])
        # A sentence starts with white space and no lower-case letter.
        self.opens = np.array([t[:1].isspace() and not t[1:2].islower() for t in texts])

    def after(self, ids: np.ndarray) -> np.ndarray:
        """Whether a sentence or line ends after each of the ids, the last one left out."""
        ended, wide = self.ends[ids], self.wide[ids]
        closes, line = self.closes[ids], self.line[ids]
        for _ in range(2):  # closing marks may be ids of their own
            ended[1:] |= closes[1:] & ended[:-1]
            wide[1:] |= closes[1:] & wide[:-1]
        sentence = ended[:-1] & self.opens[ids[1:]] | wide[:-1] & ~closes[1:]
        return (sentence | line[:-1]) & ~line[1:]


def _places(ids: np.ndarray, pauses: Pauses, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, penalties) of one block; ``ends`` are those of its documents."""
    worth = np.full(len(ids) + 1, -1, np.int64)
    worth[np.flatnonzero(pauses.after(ids)) + 1] = SENTENCE
    worth[ends] = 0
    pausing = np.flatnonzero(worth >= 0)
    edges = np.concatenate([[0], pausing, [len(ids)]])
    for at in np.flatnonzero(np.diff(edges) > LONG).tolist():
        inner = slice(int(edges[at]) + STRIDE, int(edges[at + 1]), STRIDE)
        worth[inner] = INSIDE
    worth[0] = -1
    places = np.flatnonzero(worth >= 0)
    return places, worth[places]


class _Stream:
    """A partition's documents: blocks of tokens become pieces in sequences."""

    def __init__(self, pauses: Pauses, capacity: int) -> None:
        self.pauses, self.capacity = pauses, capacity
        # (key, ids, ids of the document before these, all of them, whether the document ends here)
        self.held: list[tuple] = []
        self.size = 0
        self.sequence = TaskContext.get().partitionId() << 40 if TaskContext.get() else 0

    def add(self, key: object, ids: np.ndarray) -> Iterator[list[tuple]]:
        for at in range(0, len(ids), BLOCK):
            part = ids[at : at + BLOCK]
            self.held.append((key, part, at, len(ids), at + len(part) == len(ids)))
            self.size += len(part)
            if self.size >= BLOCK:
                yield self.cut(last=False)

    def cut(self, last: bool) -> list[tuple]:
        """Pieces of the held tokens; unless they are the ``last``, those after the last cut stay."""
        ids = np.concatenate([h[1] for h in self.held])
        stops = np.cumsum([len(h[1]) for h in self.held])
        ends = stops[[h[4] for h in self.held]]
        places, worth = _places(ids, self.pauses, ends)
        cuts = np.array(best_cuts(places, worth, self.capacity, last), np.int64)
        bounds = np.union1d(stops[stops < cuts[-1]], cuts)
        starts = np.concatenate([[0], bounds[:-1]])
        of = np.searchsorted(stops, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        offsets = starts - np.concatenate([[0], cuts])[window]
        first = stops - np.array([len(h[1]) for h in self.held])
        data = memoryview(ids.astype("<u4").tobytes())
        pieces = []
        for start, end, n, number, offset in zip(
            starts.tolist(), bounds.tolist(), of.tolist(), window.tolist(), offsets.tolist(), strict=True
        ):
            key, _, before, whole, _ = self.held[n]
            at = before + start - int(first[n])
            crc = zlib.crc32(data[4 * start : 4 * end])
            pieces.append((key, at, end - start, crc, whole, self.sequence + number, offset))
        self.sequence += len(cuts)
        self._keep(int(cuts[-1]), first)
        return _joined(pieces, data)

    def _keep(self, cut: int, first: np.ndarray) -> None:
        left = []
        for (key, part, before, whole, ended), start in zip(self.held, first.tolist(), strict=True):
            used = min(max(cut - start, 0), len(part))
            if used < len(part):
                left.append((key, part[used:], before + used, whole, ended))
        self.held, self.size = left, sum(len(h[1]) for h in left)


def _joined(pieces: list[tuple], data: memoryview) -> list[tuple]:
    """Neighbouring parts of one document in one sequence are one piece."""
    out: list[tuple] = []
    at = 0
    for piece in pieces:
        key, start, length, crc, whole, sequence, offset = piece
        if out:
            prior = out[-1]
            if start and prior[5] == sequence and prior[1] + prior[2] == start and prior[6] + prior[2] == offset:
                crc = zlib.crc32(data[4 * at : 4 * (at + length)], prior[3])
                piece = (key, prior[1], prior[2] + length, crc, whole, sequence, prior[6])
                out.pop()
        out.append(piece)
        at += length
    return out


def windows(
    df: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2_048,
    end_id: int = 1,
) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset): every id of every row once.

    A row's ids are those of its whole text and then ``end_id``; null and empty texts have that id alone.
    Each partition's rows stay in their order; no row is shuffled, and only the last window of a
    partition can be far from full.  Sequences of a power of two of tokens need no padding, others are
    padded to ``capacity``.  Repeated rows and null keys are packed like any others; an empty table gives
    no rows; other columns are not read.  Texts longer than a block go through it in parts.
    """
    if capacity < LONG:
        raise ValueError(f"windows hold at least {LONG} tokens")
    kind = df.schema[key].dataType
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def fresh() -> tuple[codec.Codec, Pauses]:
        coder = codec.Codec(vocabulary)
        known = [coder.fast.decode_single_token_bytes(i) for i in range(len(coder.widths))]
        return coder, Pauses(known + [b""] * (coder.library.get_vocab_size() - len(known)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, pauses = tasks.worker_cache(f"windows {vocabulary}", fresh)
        stream, keys = _Stream(pauses, capacity), None

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True))
            arrays = [pa.array(columns[0], keys), *(pa.array(c, pa.int64()) for c in columns[1:])]
            return pa.RecordBatch.from_arrays(arrays, names=[key, *names])

        for batch in batches:
            keys = batch.schema.field(0).type
            for part in tasks.slices(batch, 1):
                texts = zip(part.column(0).to_pylist(), coder.encode(part.column(1).to_pylist()), strict=True)
                for name, ids in texts:
                    whole = np.append(np.frombuffer(ids, "<u4"), np.uint32(end_id))
                    for pieces in stream.add(name, whole):
                        yield out(pieces)
        if stream.size:
            yield out(stream.cut(last=True))

    rows = df.select(F.col(key), F.col(text).cast("string").alias(f"{key} text"))
    fields = ", ".join(f"{n} bigint" for n in names)
    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, {fields}")
