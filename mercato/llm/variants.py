"""Spelling variants: words one edit apart, found by dense tiles of padded code-point matrices.

Two words are one edit apart when their common prefix and common suffix together reach the longer
length less one.  So they share the first or the last half of their code points, and words meet in
tiles by such a half.  A half that too many words share is halved again; the middle that is left
shrinks to one code point, which no more words can share than there are letters.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Code points of the shortest word, and the characters of words once A-Z are lower case.
SHORTEST = 6
_RUN = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# One in so many runs of a document loses a code point.
SLIP = 199
# Distinct words a task counts before it hands them on.
COUNTED = 1 << 18
# Words of one group that are compared as they are, rows of a tile, and code points of its matrix.
GROUP = 384
TILE = 256
CELLS = 1 << 22


def slipped(key: str, run: str) -> str:
    """The run, less one code point where the checksum of key and run says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{key}:".encode()))
    if h % SLIP:
        return run
    return run[: h % len(run)] + run[h % len(run) + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a task's documents with their numbers, handed on whenever many are held."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            buffer = text.as_buffer()
            if buffer is None:
                continue
            own = Counter(_RUN.findall(buffer.to_pybytes().translate(_LOWER).decode()))
            start = zlib.crc32(f"{key or ''}:".encode())
            for run, n in own.items():
                h = zlib.crc32(run.encode(), start)
                if h % SLIP == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                    if len(run) < SHORTEST:
                        continue
                held[run] += n
            if len(held) > COUNTED:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(df: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """(word, n): words of at least ``SHORTEST`` code points and ``least`` occurrences."""
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t"))
    counted = rows.mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _halved(rows: DataFrame) -> DataFrame:
    """Every row under two keys: ``front`` or ``back`` grows by half of the middle between them.

    Similar words that share the longer front are found there; those under the longer back are the rest,
    whose common prefix stays below ``under``.  So no pair is found twice.
    """
    half = F.floor((F.col("longest") - F.col("front") - F.col("back")) / 2).cast("int")
    longer = F.col("front") + half
    ways = F.array(
        F.struct(longer.alias("front"), F.col("back").alias("back"), F.col("under").alias("under")),
        F.struct(
            F.col("front").alias("front"),
            (F.col("back") + half).alias("back"),
            F.least("under", longer).alias("under"),
        ),
    )
    split = rows.withColumn("way", F.explode(ways)).select("word", "n", "size", "longest", "way.*")
    shared = F.xxhash64(
        "longest", "front", "back", "under", F.expr("left(word, front)"), F.expr("right(word, back)")
    )
    return split.withColumn("shared", shared)


def _groups(words: DataFrame) -> DataFrame:
    """Words under every half by which a similar word may share them, in groups of bounded size."""
    sized = words.withColumn("size", F.char_length("word"))
    rows = _halved(
        sized.withColumn("longest", F.explode(F.array(F.col("size"), F.col("size") + 1)))
        .withColumn("front", F.lit(0))
        .withColumn("back", F.lit(0))
        .withColumn("under", F.lit(2**31 - 1))
    )
    middle = F.col("longest") - F.col("front") - F.col("back")
    ready = []
    while True:
        sizes = rows.groupBy("shared").agg(F.count("*").alias("members"), F.max("size").alias("tallest"))
        met = rows.join(sizes.filter("members > 1"), "shared").filter("tallest = longest")
        met = scratch.materialize(met.drop("tallest"), "halves")
        crowded = (F.col("members") > GROUP) & (middle > 1)
        ready.append(met.filter(~crowded))
        if met.filter(crowded).isEmpty():
            return reduce(DataFrame.unionByName, ready)
        rows = _halved(met.filter(crowded))


def _matrix(words: list[bytes]) -> np.ndarray:
    width = max(map(len, words))
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of a with every row of b."""
    same = np.ones((len(a), len(b)), bool)
    length = np.zeros((len(a), len(b)), np.uint8 if a.shape[1] < 256 else np.int32)
    for place in range(min(a.shape[1], b.shape[1])):
        same &= a[:, place, None] == b[None, :, place]
        if not same.any():
            break
        length += same.view(np.uint8)
    return length


def single_edits(words: list[str], of: np.ndarray, longest: int, under: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of one group (``of``), one edit apart, the longer of ``longest`` code points.

    Words are distinct and have that many code points or one less; common prefixes of ``under`` code points or more are another group's.  Blocks
    of words are padded to matrices and compared with each other, prefixes forward, suffixes backward.
    """
    sizes = np.array([len(w) for w in words])
    step = max(1, min(TILE, CELLS // longest))
    plain = [w.encode("latin-1") for w in words]
    blocks = [
        (_matrix(plain[at : at + step]), _matrix([w[::-1] for w in plain[at : at + step]]), slice(at, at + step))
        for at in range(0, len(words), step)
    ]
    found = []
    for n, (heads, tails, rows) in enumerate(blocks):
        for other_heads, other_tails, columns in blocks[n:]:
            if not (of[rows].max() >= of[columns].min() and of[rows].min() <= of[columns].max()):
                continue
            fits = of[rows][:, None] == of[columns][None, :]
            tall = sizes == longest
            fits &= tall[rows][:, None] | tall[columns][None, :]
            if rows == columns:
                fits &= np.arange(fits.shape[0])[:, None] < np.arange(fits.shape[1])[None, :]
            # Padding agrees beyond the end of two shorter words only, and those do not fit.
            prefix = _common(heads, other_heads)
            fits &= prefix < under[rows][:, None]
            i, j = np.nonzero(fits)
            suffix = _common(tails, other_tails)
            reached = prefix[i, j].astype(np.int64) + suffix[i, j] >= longest - 1
            i, j = i[reached], j[reached]
            found.append((i + rows.start, j + columns.start))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, near, near_n) both ways, for rows sorted by longest word and group."""

    def out(held: pa.Table) -> Iterator[pa.RecordBatch]:
        words, numbers = held.column("word").combine_chunks(), held.column("n").combine_chunks()
        of, under = (held.column(c).to_numpy() for c in ("shared", "under"))
        longest = held.column("longest")[0].as_py()
        # Whole groups side by side fill a tile.
        for first, last in _tiles(of):
            i, j = single_edits(
                words.slice(first, last - first).to_pylist(),
                of[first:last],
                longest,
                under[first:last],
            )
            a, b = pa.array(np.concatenate([i, j]) + first), pa.array(np.concatenate([j, i]) + first)
            yield pa.RecordBatch.from_arrays(
                [words.take(a), words.take(b), numbers.take(b)], names=["word", "near", "near_n"]
            )

    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        longest, of = held.column("longest").to_numpy(), held.column("shared").to_numpy()
        cuts = np.flatnonzero((longest[1:] != longest[:-1]) | (of[1:] != of[:-1])) + 1
        # All but the last group are whole; those of one length are handled together.
        for part in _runs(longest, cuts):
            yield from out(held.slice(part[0], part[1] - part[0]))
        if len(cuts):
            held = held.slice(int(cuts[-1])).combine_chunks()
    if held is not None and held.num_rows:
        yield from out(held)


def _runs(longest: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of equal ``longest`` up to the last cut."""
    if not len(cuts):
        return
    end = int(cuts[-1])
    edges = [0, *(np.flatnonzero(longest[1:end] != longest[: end - 1]) + 1).tolist(), end]
    yield from zip(edges, edges[1:], strict=False)


def _tiles(of: np.ndarray) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups of about a tile; a larger group comes alone."""
    ends = [*(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
    first = last = 0
    for end in ends:
        if last > first and end - first > TILE:
            yield first, last
            first = last
        last = end
    yield first, last


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words one edit apart, both ways, each once."""
    groups = _groups(words).select("word", "n", "longest", "under", "shared")
    # Tiles cost time, not bytes: as many tasks as the session plans for, however small the table.
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = groups.repartition(parts, "longest", "shared").sortWithinPartitions("longest", "shared", "word")
    return dealt.mapInArrow(_meet, "word string, near string, near_n bigint")


def variants(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = 5, times: int = 5
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    Words are the maximal runs of Latin letters of whole texts, A-Z lower-cased, of six code points or
    more and at least ``least`` occurrences; one in ``SLIP`` runs of a document loses a code point first.
    A word's form is its near word (one code point more, less or another) of largest n, ties to the
    smallest, if that is ``times`` its own n; its root is where the forms lead.

    Null and empty texts have no words; a null key counts as empty text in the checksum; repeated rows
    count each; an empty table gives no rows; other columns are not read.  Words that share a half with
    very many others are dealt by longer halves; nothing about all words meets in one task.
    """
    if times < 2:
        raise ValueError("a form has at least twice the occurrences")
    words = scratch.materialize(vocabulary(df, key, text, least), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    follows = -F.col("best.n") >= times * F.col("n")
    known = scratch.materialize(
        words.join(near, "word", "left").select(
            "word",
            F.when(follows, F.col("best.word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(follows, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    roots = known.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    # Every form has ``times`` its follower's n, so paths are short; each round doubles what is followed.
    most = known.agg(F.max("form_n")).first()[0] or 0
    reached = 1
    while least * times ** (reached + 1) <= most:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = scratch.materialize(
            roots.join(beyond, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots"
        )
        reached *= 2
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
