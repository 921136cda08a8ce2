"""Benchmark decontamination: an FM-index per shard of training text, searched for test phrases.

A shard is some megabytes of documents.  Its index covers the stretches of words that the benchmark
knows and that are long enough for its shortest phrase; any other word ends a stretch.  Phrases are
looked up back to front by ranks in a wavelet tree over the transformed text, their occurrences are
located through sampled suffix positions, and overlapping ones merge into spans.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch
from mercato.llm import tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words of a phrase; shorter items are one phrase.
WINDOW = 10
# Text of a shard.
SHARD_BYTES = 4 << 20
# Every so many text positions one is kept in the index.
SAMPLE = 8
# Phrases searched side by side, and windows of the benchmark, each with an item, of one pass over the documents.
SEARCHED = 1 << 16
PASS_WINDOWS = 1 << 20
# Windows of an item that are handed on together.
WINDOWS_AT_ONCE = 1 << 14
# Words of the shard per block of rank counts.
RANK_BLOCK = 64

LOWER, WORD = tasks.byte_tables(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


class Bits:
    """Bits with the number of ones before any place."""

    def __init__(self, bits: np.ndarray) -> None:
        self.size = len(bits)
        padded = np.zeros(-(-(len(bits) + 1) // RANK_BLOCK) * RANK_BLOCK, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.append(0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64))

    def rank(self, at: np.ndarray) -> np.ndarray:
        block, rest = at >> 6, (at & 63).astype(np.uint64)
        part = self.words[block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[block] + np.bitwise_count(part)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)


class WaveletTree:
    """A sequence of small numbers, one level per bit, highest first; each level keeps zeros before ones."""

    def __init__(self, values: np.ndarray, width: int) -> None:
        self.width, self.levels, self.zeros = width, [], []
        for shift in range(width - 1, -1, -1):
            bits = ((values >> shift) & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            values = np.concatenate([values[~bits], values[bits]])

    def ranks(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        first, last = np.zeros_like(at), at
        for level, zeros, shift in zip(self.levels, self.zeros, range(self.width - 1, -1, -1), strict=True):
            one = ((symbols >> shift) & 1).astype(bool)
            a, b = level.rank(first), level.rank(last)
            first, last = np.where(one, zeros + a, first - a), np.where(one, zeros + b, last - b)
        return last - first

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place and how often it occurs before it."""
        symbols, first = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            bit = level.get(at).astype(bool)
            a, b = level.rank(first), level.rank(at)
            symbols = symbols * 2 + bit
            first, at = np.where(bit, zeros + a, first - a), np.where(bit, zeros + b, at - b)
        return symbols, at - first


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Places of the text's suffixes in order.  The text ends in its only smallest number.

    Ranks by a growing number of first words; only suffixes that still share theirs are sorted again.
    """
    size = len(text)
    order = np.argsort(text, kind="stable")
    sorted_text = text[order]
    heads = np.flatnonzero(np.append(True, sorted_text[1:] != sorted_text[:-1]))
    rank = np.empty(size, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, size)))
    step = 1
    open_ = np.flatnonzero(np.repeat(np.diff(np.append(heads, size)) > 1, np.diff(np.append(heads, size))))
    while len(open_):
        # The places of the order that are not settled yet, group by group.
        suffixes = order[open_]
        own = rank[suffixes]
        after = rank[np.minimum(suffixes + step, size - 1)]
        by = np.lexsort((after, own))
        suffixes, own, after = suffixes[by], own[by], after[by]
        order[open_] = suffixes
        new = np.append(True, (own[1:] != own[:-1]) | (after[1:] != after[:-1]))
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(suffixes)))
        rank[suffixes] = np.repeat(open_[starts], sizes)
        open_ = open_[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


class Index:
    """The FM-index of one text of numbers from 1; 0 is its end."""

    def __init__(self, text: np.ndarray, symbols: int) -> None:
        text = np.append(text, 0).astype(np.int64)
        places = suffix_array(text)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols + 1))])
        self.tree = WaveletTree(text[places - 1], max(1, int(symbols).bit_length()))
        kept = places % SAMPLE == 0
        self.kept, self.places = Bits(kept), places[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase; phrases are rows, back to front, -1 fills up."""
        first = np.zeros(len(phrases), np.int64)
        last = np.full(len(phrases), self.kept.size, np.int64)
        for column in phrases.T:
            going = np.flatnonzero((column >= 0) & (first < last))
            if not len(going):
                break
            word = column[going]
            first[going] = self.before[word] + self.tree.ranks(word, first[going])
            last[going] = self.before[word] + self.tree.ranks(word, last[going])
        return first, np.maximum(first, last)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffixes: steps back through the text to the next sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        found = np.full(len(rows), -1, np.int64)
        going = np.arange(len(rows))
        while len(going):
            here = rows[going]
            there = self.kept.get(here).astype(bool)
            done = going[there]
            found[done] = self.places[self.kept.rank(rows[done])] + steps[done]
            going = going[~there]
            word, count = self.tree.access(rows[going])
            rows[going] = self.before[word] + count
            steps[going] += 1
        return found


class Phrases:
    """Some windows of the benchmark: rows of word hashes, and the items each belongs to."""

    def __init__(self, windows: list[bytes], names: list[str | None]) -> None:
        """``windows``: the hashes of a window's words, 8 bytes each; ``names``: an item with it, if named."""
        by_window: dict[bytes, set[str]] = {}
        for window, name in zip(windows, names, strict=True):
            own = by_window.setdefault(window, set())
            if name is not None:
                own.add(name)
        self.names = [sorted(names) for names in by_window.values()]
        hashes = np.frombuffer(b"".join(by_window), np.uint64)
        self.words, numbers = np.unique(hashes, return_inverse=True)
        self.sizes = np.fromiter(map(len, by_window), np.int64, len(by_window)) // 8
        self.back = np.full((len(by_window), WINDOW), -1, np.int64)
        row = np.repeat(np.arange(len(self.sizes)), self.sizes)
        ends = np.cumsum(self.sizes)
        self.back[row, ends[row] - 1 - np.arange(len(hashes))] = numbers + 1
        self.shortest = int(self.sizes.min())


def occurrences(
    hashes: np.ndarray, firsts: np.ndarray, phrases: Phrases
) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, word place) of every occurrence in one shard's words."""
    known = phrases.words
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    symbols = np.where(known[at] == hashes, at + 2, 1)  # 1 ends a stretch
    document = np.zeros(len(hashes), bool)
    inner = firsts[:-1]
    document[inner[inner < len(hashes)]] = True
    inside = symbols > 1
    starts = np.flatnonzero(inside & (np.append(True, ~inside[:-1]) | document))
    # The end of a stretch: the next word outside, or the next document.
    stops = np.append(np.flatnonzero(~inside | document), len(hashes))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    long_enough = ends - starts >= phrases.shortest
    starts, lengths = starts[long_enough], (ends - starts)[long_enough]
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # Stretch after stretch, an end mark after each.
    total = int((lengths + 1).sum())
    begins = np.append(0, np.cumsum(lengths + 1)[:-1])
    place = np.arange(total) - np.repeat(begins, lengths + 1) + np.repeat(starts, lengths + 1)
    marks = begins + lengths
    text = np.empty(total, np.int64)
    text[:] = symbols[np.minimum(place, len(hashes) - 1)]
    text[marks] = 1
    index = Index(text, len(known) + 1)
    rows, found = [], []
    for block in range(0, len(phrases.sizes), SEARCHED):
        back = phrases.back[block : block + SEARCHED]
        first, last = index.search(np.where(back > 0, back + 1, -1))
        counts = last - first
        hit = np.repeat(np.arange(len(back)), counts)
        suffixes = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
        rows.append(hit + block)
        found.append(place[index.locate(suffixes)])
    return np.concatenate(rows), np.concatenate(found)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, name) of every window of every item; a window is written as its words' hashes."""
    for batch in batches:
        for part in tasks.slices(batch, 1):
            hashes, firsts = tasks.word_hashes(*tasks.flat(part.column(1)), LOWER, WORD)
            data = hashes.tobytes()
            for row, name in enumerate(part.column(0).to_pylist()):
                start, end = int(firsts[row]), int(firsts[row + 1])
                size = min(WINDOW, end - start)
                for first in range(start, end - size + 1 if size else start, WINDOWS_AT_ONCE):
                    starts = range(first, min(first + WINDOWS_AT_ONCE, end - size + 1))
                    found = pa.array([data[8 * i : 8 * (i + size)] for i in starts], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [found, pa.array([name] * len(found), pa.string())], names=["window", "name"]
                    )


def _benchmark(benchmark: DataFrame, key: str, text: str) -> Iterator[Phrases]:
    """The benchmark's distinct windows, in blocks of about PASS_WINDOWS; the driver holds one block."""
    items = benchmark.select(F.col(key).cast("string").alias("name"), F.col(text).cast("string").alias("item text"))
    pairs = scratch.materialize(items.mapInArrow(_windows, "window binary, name string").distinct(), "windows")
    blocks = -(-pairs.count() // PASS_WINDOWS)
    for block in range(blocks):
        # Pairs are distinct, so their hashes deal them evenly, a window of many items too.
        mine = pairs.filter(F.pmod(F.xxhash64("window", "name"), F.lit(blocks)) == block).toArrow()
        if mine.num_rows:
            yield Phrases(mine.column("window").to_pylist(), mine.column("name").to_pylist())


def _merged(starts: np.ndarray, ends: np.ndarray) -> list[dict[str, int]]:
    """Overlapping or touching spans as one."""
    spans: list[list[int]] = []
    for start, end in sorted(zip(starts.tolist(), ends.tolist(), strict=True)):
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [{"start": a, "end": b} for a, b in spans]


SPANS = "array<struct<start: bigint, end: bigint>>"
# Names that no given column is likely to have.
FOUND = ("found words", "found spans", "found items")
FOUND_KINDS = f"`{FOUND[0]}` bigint, `{FOUND[1]}` {SPANS}, `{FOUND[2]}` array<string>"


Finish = Callable[[list[pa.Array], list[list[dict[str, int]]]], pa.RecordBatch]


def _searched(
    rows: DataFrame, columns: list[str], kinds: str, phrases: Phrases, finish: Finish | None = None
) -> DataFrame:
    """``columns`` with words, spans (of word places) and items of one block of the benchmark.

    ``finish`` makes the result of the columns and spans instead, in the same task.
    """
    shared = tasks.Shared(rows.sparkSession, phrases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            for part in tasks.slices(batch, batch.num_columns - 1, SHARD_BYTES):
                hashes, firsts = tasks.word_hashes(*tasks.flat(part.column(part.num_columns - 1)), LOWER, WORD)
                which, places = occurrences(hashes, firsts, wanted)
                order = np.argsort(places, kind="stable")
                which, places = which[order], places[order]
                cuts = np.searchsorted(places, firsts)
                spans, items = [], []
                for row in range(part.num_rows):
                    own = which[cuts[row] : cuts[row + 1]]
                    start = places[cuts[row] : cuts[row + 1]] - firsts[row]
                    spans.append(_merged(start, start + wanted.sizes[own]))
                    items.append(sorted({name for w in np.unique(own) for name in wanted.names[w]}))
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                if finish:
                    yield finish(kept, spans)
                    continue
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                found = [pa.array(np.diff(firsts)), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*kept, *found], names=[*columns, *FOUND])

    return rows.mapInArrow(run, kinds if finish else f"{kinds}, {FOUND_KINDS}")


def _none(rows: DataFrame, columns: list[str], kinds: str) -> DataFrame:
    """The result without any phrase to look for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tasks.slices(batch, batch.num_columns - 1, SHARD_BYTES):
                _, firsts = tasks.word_hashes(*tasks.flat(part.column(part.num_columns - 1)), LOWER, WORD)
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(np.diff(firsts))], names=[*columns, FOUND[0]])

    return rows.mapInArrow(run, f"{kinds}, `{FOUND[0]}` bigint").withColumns(
        {FOUND[1]: F.array().cast(SPANS), FOUND[2]: F.array().cast("array<string>")}
    )


def _union(spans: F.Column) -> F.Column:
    """Overlapping or touching spans of several blocks as one."""
    last = lambda a: F.element_at(a, -1)
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(SPANS),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.when(F.size(done) > 0, last(done)["end"])),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(last(done)["start"].alias("start"), F.greatest(last(done)["end"], s["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )


def contaminated_spans(
    df: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``columns`` of every row with n_words, spans and items.

    Words are runs of the bytes 0-9, a-z (A-Z lower-cased) and 0x80-0xFF.  A phrase is 10 consecutive
    words of an item, or a shorter item's whole sequence.  Spans are (start, end) in words, end
    exclusive, merged; items the ids (as strings, sorted) with an occurring phrase.  Null and empty
    texts have no words; the words of items without an id are hit too, but items does not name them;
    repeated rows get equal results; empty tables give no rows or no hits.  Words are compared by 64-bit
    hashes.

    The benchmark's windows are made and told apart on Spark and searched in blocks of about
    PASS_WINDOWS; with one block no document is shuffled.
    """
    found = _found(df, benchmark, columns, text, item_key, item_text)
    names = zip(FOUND, ("n_words", "spans", "items"), strict=True)
    return found.select(*columns, *[F.col(f"`{a}`").alias(b) for a, b in names])


def _found(
    df: DataFrame,
    benchmark: DataFrame,
    columns: list[str],
    text: str,
    item_key: str,
    item_text: str,
    finish: Finish | None = None,
) -> DataFrame:
    """``columns`` with the columns named in FOUND, or what ``finish`` makes of ``columns`` and spans."""
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    rows = df.select(*[F.col(c) for c in columns], F.col(text).cast("string").alias("searched text"))
    blocks = _benchmark(benchmark, item_key, item_text)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return df.select(*columns) if finish else _none(rows, columns, kinds)
    if second is None:
        return _searched(rows, columns, kinds, first, finish)
    # Keys may be null or repeat: rows are told apart by their place in a stored table.
    place = "found row"
    stored = scratch.materialize(rows, "documents").withColumn(place, F.monotonically_increasing_id())
    rows = stored.select(*columns, place, "searched text")
    columns, kinds = [*columns, place], f"{kinds}, `{place}` bigint"
    done = _searched(rows, columns, kinds, first)
    words, spans, items = FOUND
    for block in chain([second], blocks):
        more = _searched(rows, columns, kinds, block).select(
            F.col(place), F.col(spans).alias("more spans"), F.col(items).alias("more items")
        )
        done = scratch.materialize(
            done.join(more, place).select(
                *columns,
                words,
                _union(F.concat(F.col(spans), F.col("more spans"))).alias(spans),
                F.array_sort(F.array_union(F.col(items), F.col("more items"))).alias(items),
            ),
            "spans",
        )
    if not finish:
        return done.drop(place)
    width = len(columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield finish(batch.columns[:width], batch.column(width + 2).to_pylist())

    return done.mapInArrow(run, df.select(*columns[:width]).schema)


_WORDS = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


def cut(text: str, spans: list[dict[str, int]]) -> str:
    """The text without the spans, from each one's first word to its last."""
    words = [m.span() for m in _WORDS.finditer(text)]
    kept, at = [], 0
    for span in spans:
        kept.append(text[at : words[span["start"]][0]])
        at = words[span["end"] - 1][1]
    return "".join([*kept, text[at:]])


def decontaminated(df: DataFrame, benchmark: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``df`` with benchmark phrases cut out of the texts and ``length``, if there, set anew where that happened.

    Rows of which a cut leaves no word go; all others stay, those without a hit unchanged, so also rows
    without text.  Repeated rows are cut alike; empty tables give no rows or change none.
    """
    columns = list(df.columns)
    at, size = columns.index(text), columns.index(length) if length in columns else None

    def finish(arrays: list[pa.Array], spans: list[list[dict[str, int]]]) -> pa.RecordBatch:
        arrays = list(arrays)
        hit = [row for row, found in enumerate(spans) if found]
        if hit:
            texts, keep = arrays[at].to_pylist(), [True] * len(spans)
            sizes = arrays[size].to_pylist() if size is not None else texts
            for row in hit:
                texts[row] = cut(texts[row], spans[row])
                keep[row] = bool(_WORDS.search(texts[row]))
                if size is not None:
                    sizes[row] = len(texts[row])
            arrays[at] = pa.array(texts, arrays[at].type)
            if size is not None:
                arrays[size] = pa.array(sizes, arrays[size].type)
            return pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(keep))
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    return _found(df, benchmark, columns, text, "item_id", "text", finish)
