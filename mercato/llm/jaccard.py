"""Similarity join of documents on their word n-grams: a prefix-tree join.

Equal sets form one class, so copies meet once.  All sets are kept in one global order, frequent
n-grams first.  Read from the rare end, two sets that are similar enough share one of their first few
n-grams; so classes meet under those.  Sets that meet are stored in a trie; another set is matched
against all of them in one walk that shares the overlap of common paths and leaves a subtree when what
remains on either side can no longer reach the overlap asked for.
"""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato import scratch
from mercato.llm import tasks
from mercato.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
# Similar means 100 * intersection >= PERCENT * union.
PERCENT = 80
# The order knows the most frequent n-grams by name: so many of them.  Tasks name those that they see
# often themselves; then all are counted at the sets' rare ends, and those that so many rows have there
# are named as well.
NAMED = 1 << 18
OFTEN = 48
NAMED_AT_ENDS = 1 << 20
OFTEN_AT_ENDS = 12
# Shingles a task collects before it counts them.
COUNTED = 1 << 21
# A class is matched with a centre that it meets at least a fourth as often as similar sets must.
HOPE = 4
# Sets in one trie.
TRIE_SETS = 256
# Members that meet in one group of a frequent n-gram.
GROUP = 4_096

LOWER, WORD = tasks.byte_tables(lambda b: b != 32 and not 9 <= b <= 13)
_STEP = np.uint64(0x9FB21C651E98DF25)
_RARE = np.uint64(1 << 63)
_SPLIT = 1 << 62
_RANK_BITS = 21


def least_overlap(a: int, b: int) -> int:
    """The smallest intersection of two similar sets of these sizes."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


def prefix_length(size: int) -> int:
    """N-grams of a set of which a similar set must share one, read from the rare end."""
    return size - -(-PERCENT * size // 100) + 1


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct n-grams; fewer words make one n-gram."""
    data, offsets = tasks.flat(column)
    words, firsts = tasks.word_hashes(data, offsets, LOWER, WORD)
    if len(words) >= WORDS:
        grams = words[: len(words) - WORDS + 1].copy()
        for i in range(1, WORDS):
            grams *= _STEP
            grams += words[i : len(words) - WORDS + 1 + i]
        grams = tasks.mix(grams)
    sets = []
    for first, last in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if last - first >= WORDS:
            sets.append(np.unique(grams[first : last - WORDS + 1]))
        elif last > first:
            whole = np.full(1, last - first, np.uint64)
            for word in words[first:last]:
                whole = whole * _STEP + word
            sets.append(tasks.mix(whole))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def _digest(grams: np.ndarray) -> tuple[int, int]:
    found = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64)
    return int(found[0]), int(found[1])


# --- Frequent n-grams: one bounded table per task, merged as a tree -------------------------------


def _pack(grams: np.ndarray, counts: np.ndarray) -> bytes:
    if len(grams) > NAMED:
        best = np.argpartition(-counts, NAMED)[:NAMED]
        grams, counts = grams[best], counts[best]
    return zlib.compress(grams.tobytes() + counts.astype(np.int64).tobytes(), 1)


def _unpack(record: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = zlib.decompress(record)
    half = len(both) // 2
    return np.frombuffer(both[:half], np.uint64), np.frombuffer(both[half:], np.int64)


def _sum(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, places = np.unique(grams, return_inverse=True)
    return names, np.bincount(places, weights=counts, minlength=len(names)).astype(np.int64)


def merge_counts(records: list[bytes]) -> bytes:
    tables = [_unpack(r) for r in records]
    return _pack(*_sum(np.concatenate([t[0] for t in tables]), np.concatenate([t[1] for t in tables])))


def order_keys(grams: np.ndarray, named: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The set in the global order: named n-grams by falling frequency, then all others by hash."""
    keys = (grams >> np.uint64(1)) | _RARE
    if len(named):
        at = np.minimum(np.searchsorted(named, grams), len(named) - 1)
        known = named[at] == grams
        keys[known] = ranks[at[known]]
    keys.sort()
    return keys


# --- The trie -------------------------------------------------------------------------------------


class Trie:
    """Sets in the global order, common beginnings stored once; a node holds a stretch of n-grams."""

    __slots__ = ("children", "ends", "grams", "longest", "shortest")

    def __init__(self, sets: list[tuple[int, np.ndarray]], depth: int = 0) -> None:
        """``sets``: (name, ordered set), sorted as sequences, alike up to ``depth``."""
        sizes = [len(s) for _, s in sets]
        self.shortest, self.longest = min(sizes), max(sizes)
        first, last = sets[0][1], sets[-1][1]
        most = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:most] != last[depth:most])
        end = depth + int(differ[0]) if len(differ) else most
        self.grams = first[depth:end]
        self.ends = [name for name, s in sets if len(s) == end]
        self.children = []
        rest = [item for item in sets if len(item[1]) > end]
        at = 0
        while at < len(rest):
            gram, to = rest[at][1][end], at + 1
            while to < len(rest) and rest[to][1][end] == gram:
                to += 1
            self.children.append(Trie(rest[at:to], end))
            at = to

    @classmethod
    def of(cls, sets: list[tuple[int, np.ndarray]]) -> Trie:
        return cls(sorted(sets, key=lambda item: item[1].astype(">u8").tobytes()))

    def similar(self, probe: np.ndarray) -> Iterator[int]:
        """Names of the stored sets similar to ``probe``."""
        size = len(probe)
        waiting = [(self, 0, 0)]
        while waiting:
            node, depth, overlap = waiting.pop()
            # No stored length below this node can be similar.
            shortest = max(node.shortest, -(-PERCENT * size // 100))
            if shortest > min(node.longest, 100 * size // PERCENT):
                continue
            if len(node.grams):
                at = np.searchsorted(probe, node.grams)
                inside = at < size
                overlap += int((probe[at[inside]] == node.grams[inside]).sum())
                depth += len(node.grams)
                passed = int(np.searchsorted(probe, node.grams[-1], side="right"))
            else:
                passed = 0
            for name in node.ends:
                if overlap >= least_overlap(size, depth):
                    yield name
            # What can still be gained is what is left of the probe, or of the stored sets.
            left = size - passed
            reach = min(node.longest, 100 * size // PERCENT)
            if overlap + min(left, reach - depth) < least_overlap(size, max(shortest, depth)):
                continue
            waiting += [(child, depth, overlap) for child in node.children]


def _match(probe_links: bool) -> Callable[[tuple, pa.Table], pa.Table]:
    """Links of one group's probes with its stored sets; all, or one per probe."""

    def run(group: tuple, table: pa.Table) -> pa.Table:
        names = table.column("class").to_pylist()
        sets = [np.frombuffer(b, np.uint64) for b in table.column("grams").to_pylist()]
        probes = table.column("probe").to_pylist()
        stored = [(n, s) for n, s, p in zip(names, sets, probes, strict=True) if not p]
        a, b = [], []
        if stored:
            trie = Trie.of(stored)
            for name, grams, probe in zip(names, sets, probes, strict=True):
                if probe:
                    for other in trie.similar(grams):
                        a.append(name)
                        b.append(other)
                        if not probe_links:
                            break
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


# --- The join -------------------------------------------------------------------------------------


def _signed(rows: DataFrame) -> DataFrame:
    """Per row its set's size and digest, and per task a table of frequent n-grams (in ``counts``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        named, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def count() -> None:
            nonlocal held, size, named, counts
            if not held:  # the last rows were counted as they came
                return
            grams, seen = np.unique(np.concatenate(held), return_counts=True)
            named, counts = _sum(
                np.concatenate([named, grams[seen > 1]]), np.concatenate([counts, seen[seen > 1]])
            )
            if len(named) > NAMED:
                best = np.argpartition(-counts, NAMED)[:NAMED]
                named, counts = named[best], counts[best]
            held, size = [], 0

        def out(keys: pa.Array, sizes: list, digests: list, table: list) -> pa.RecordBatch:
            columns = [keys, pa.array(sizes, pa.int64())]
            columns += [pa.array([d and d[i] for d in digests], pa.int64()) for i in (0, 1)]
            columns.append(pa.array(table, pa.binary()))
            return pa.RecordBatch.from_arrays(columns, names=["key", "size", "d1", "d2", "counts"])

        kept_type = None
        for batch in batches:
            kept_type = batch.column(0).type
            for part in tasks.slices(batch, 1):
                sets = shingle_sets(part.column(1))
                held += sets
                size += sum(map(len, sets))
                if size > COUNTED:
                    count()
                digests = [_digest(s) if len(s) else None for s in sets]
                yield out(part.column(0), [len(s) for s in sets], digests, [None] * len(sets))
        if kept_type is not None:
            count()
            yield out(pa.nulls(1, kept_type), [None], [None], [_pack(named, counts)])

    return rows.mapInArrow(run, "key bigint, size bigint, d1 bigint, d2 bigint, counts binary")


def _ordered(rows: DataFrame, shared, shares: np.ndarray | None, wanted=None) -> DataFrame:
    """Per row digest and ordered set: with ``shares`` only the end that must meet, else whole sets of
    rows with the wanted keys or none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, ranks = shared.value
        for batch in batches:
            for part in tasks.slices(batch if wanted is None else _with_keys(batch, wanted.value), 1):
                sets = [s for s in shingle_sets(part.column(1)) if len(s)]
                digests = [_digest(s) for s in sets]
                ordered = [order_keys(s, named, ranks) for s in sets]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                if shares is not None:
                    ends = [
                        _dealt(s[len(s) - prefix_length(len(s)) :], d[0], shares)
                        for s, d in zip(ordered, digests, strict=True)
                    ]
                    grams = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, ends)]), pa.int32()),
                        pa.array(np.concatenate([*ends, np.empty(0, np.uint64)]).view(np.int64)),
                    )
                else:
                    grams = pa.array([s.tobytes() for s in ordered], pa.binary())
                columns = [*(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)), sizes, grams]
                yield pa.RecordBatch.from_arrays(columns, names=["d1", "d2", "size", "grams"])

    shape = "binary" if shares is None else "array<bigint>"
    found = rows.mapInArrow(run, f"d1 bigint, d2 bigint, size bigint, grams {shape}")
    return found.dropDuplicates(["d1", "d2"])


def _with_keys(batch: pa.RecordBatch, wanted: np.ndarray) -> pa.RecordBatch:
    """The rows whose key may be wanted, and those without a key."""
    keys = batch.column(0)
    bits = tasks.filter_bits(keys.fill_null(0).to_numpy(zero_copy_only=False))
    return batch.filter(pa.array(wanted[bits] | keys.is_null().to_numpy(zero_copy_only=False)))


def _dealt(grams: np.ndarray, digest: int, shares: np.ndarray) -> np.ndarray:
    """N-grams that very many rows have get a number of the group their set goes to as well."""
    common = grams < _RARE
    if common.any():
        at = grams[common].astype(np.int64)
        many = shares[at] > 1
        group = digest % shares[at]
        grams = grams.copy()
        grams[common] = np.where(many, _SPLIT | (group << _RANK_BITS) | at, at).astype(np.uint64)
    return grams


def _stars(entries: DataFrame) -> DataFrame:
    """(gram, class, mark, centre, centre_mark) of every n-gram with several classes.

    A mark holds a set's size and the n-gram's place from its rare end.  Entries come sorted; a group's
    first class, one of the smallest sets, is its centre.  One pass, a row of memory per group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the first class of a group of which no other has been seen
        gram = centre = None
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, names, sizes = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
            if held is not None or gram is not None:  # go on with the last group
                first = held if held is not None else (gram, *centre)
                grams, names, sizes = (np.concatenate([[f], x]) for f, x in zip(first, (grams, names, sizes), strict=True))
            seen = held is None and gram is not None
            begins = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            counts = np.diff(np.append(begins, len(grams)))
            centres, centre_sizes = np.repeat(names[begins], counts), np.repeat(sizes[begins], counts)
            # A split n-gram's classes all count: the other groups hold more of them.
            several = (counts > 1) | ((grams[begins] > 0) & (grams[begins] & _SPLIT != 0))
            keep = np.repeat(several, counts)
            if seen:
                keep[0] = False  # it has gone out before
            last = begins[-1]
            if several[-1] or (seen and len(begins) == 1):
                held, gram, centre = None, grams[last], (names[last], sizes[last])
            else:
                held, gram, centre = (grams[last], names[last], sizes[last]), None, None
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep], pa.int64()) for x in (grams, names, sizes, centres, centre_sizes)],
                names=["gram", "class", "mark", "centre", "centre_mark"],
            )

    dealt = entries.select("gram", "class", "mark").repartition("gram").sortWithinPartitions("gram", "mark", "class")
    return dealt.mapInArrow(run, "gram bigint, class bigint, mark bigint, centre bigint, centre_mark bigint")


def _size(mark: str) -> Column:
    return F.shiftright(F.col(mark), 32)


def _known(met: DataFrame, labels: DataFrame) -> DataFrame:
    """(gram, class, size, place, shared, own) of every meeting.

    ``shared`` counts the n-grams under which a class meets any other, ``own`` is its component with the
    component's number of classes before it, so that components compare by size.
    """
    split = (F.col("gram") > 0) & (F.col("gram").bitwiseAND(F.lit(_SPLIT)) != 0)
    whole = F.when(split, F.col("gram").bitwiseAND(F.lit((1 << _RANK_BITS) - 1))).otherwise(F.col("gram"))
    info = met.groupBy("class").agg(F.count("*").alias("shared"))
    weights = labels.groupBy("component").agg(F.count("*").alias("weight"))
    labels = labels.join(weights, "component").withColumnRenamed("node", "class")
    info = info.join(labels, "class", "left").select(
        "class",
        "shared",
        F.struct(
            F.coalesce("weight", F.lit(1).cast("bigint")).alias("weight"),
            F.coalesce("component", "class").alias("component"),
        ).alias("own"),
    )
    rows = met.select(
        whole.alias("gram"), "class", _size("mark").alias("size"), F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF)).alias("place")
    )
    return rows.join(info, "class")


# A class (size, place, shared) and another component under an n-gram, of which sizes lie from low to high,
# the place is ``near`` at least and ``shared`` is ``most`` at most.  A similar set has a size between short
# and long; one of the n-grams that both share lies, from the rare end, before either set's size less the
# overlap needed; and both meet others often enough for the overlap that their ends must have.
_MAY_FIT = f"""
    short <= long
    AND place <= size - ceil({PERCENT} * (size + short) / {100 + PERCENT})
    AND near <= long - ceil({PERCENT} * (size + long) / {100 + PERCENT})
    AND least(shared, most) >= least(
        ceil({PERCENT} * (size + short) / {100 + PERCENT}) - ceil({PERCENT} * greatest(size, short) / 100),
        ceil({PERCENT} * (size + long) / {100 + PERCENT}) - ceil({PERCENT} * greatest(size, long) / 100))
""".replace("short", f"greatest(low, ceil({PERCENT} * size / 100))").replace(
    "long", f"least(high, floor(100 * size / {PERCENT}))"
)


def _asked(rows: DataFrame, largest: bool) -> DataFrame:
    """(class, group): components that a class of a smaller one may be similar to.

    Components are summed up per n-gram first, so a large one is a single row there, and the classes of
    an n-gram's largest component ask nobody.  With ``largest`` a class asks only the largest component
    it meets.
    """
    parts = rows.groupBy(F.col("gram").alias("their_gram"), F.col("own").alias("their")).agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.min("place").alias("near"), F.max("shared").alias("most")
    )
    tops = parts.groupBy("their_gram").agg(
        F.max(F.struct("their", "low", "high", "near", "most")).alias("top"), F.count("*").alias("n")
    )
    tops = tops.filter("n > 1").select("their_gram", "top.*")
    if largest:
        found = rows.join(tops, F.expr(f"gram = their_gram AND own < their AND {_MAY_FIT}"))
        return found.groupBy("class").agg(F.max("their").alias("their")).select("class", F.col("their.component").alias("group"))
    askers = rows.join(tops.select(F.col("their_gram").alias("top_gram"), F.col("their").alias("top")), F.expr("gram = top_gram AND own < top"))
    found = askers.drop("top_gram", "top").join(parts, F.expr(f"gram = their_gram AND own < their AND {_MAY_FIT}"))
    return found.select("class", F.col("their.component").alias("group")).distinct()


def _matched(rows: DataFrame, classes: DataFrame, shared, groups: DataFrame, all_links: bool) -> DataFrame:
    """Links (a, b) found by walking the tries of all groups (group, part, probe, class).

    The texts are read again for the sets of the classes in the groups, each from a row with the class's
    smallest key (or without a key, if none has one); a filter of fixed size leaves most other rows out
    before their sets are made, and the sets go straight to the digests that the groups ask for.
    """
    named = scratch.materialize(groups.join(classes.select("class", "d1", "d2", "rep"), "class"), "groups")
    seen = rows.sparkSession.sparkContext.broadcast(tasks.membership(named.filter("rep IS NOT NULL").select("rep")))
    whole = _ordered(rows, shared, None, seen).drop("size")
    filled = named.join(whole, ["d1", "d2"]).select("group", "part", "probe", "class", "grams")
    return filled.groupBy("group", "part").applyInArrow(_match(all_links), "a bigint, b bigint")


def _groups(stored: DataFrame, probes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Stored (group, class) dealt over tries of about TRIE_SETS sets; probes go to each of them."""
    parts = sizes.select("group", F.ceil(F.col("n") / TRIE_SETS).alias("parts"))
    kept = stored.join(parts, "group").select(
        "group", F.pmod(F.xxhash64("class"), "parts").alias("part"), F.lit(False).alias("probe"), "class"
    )
    asked = probes.join(parts, "group").select(
        "group",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("probe"),
        "class",
    )
    return kept.unionByName(asked)


def _answers(
    rows: DataFrame, classes: DataFrame, shared, met: DataFrame, labels: DataFrame, largest: bool
) -> DataFrame:
    """Links between components: classes are matched with the tries of the components they ask."""
    asked = scratch.materialize(_asked(_known(met, labels), largest), "asked")
    others = asked.select("group").distinct()
    members = others.join(labels.select(F.col("component").alias("group"), F.col("node").alias("class")), "group", "left")
    members = members.withColumn("class", F.coalesce("class", "group"))
    sizes = members.groupBy("group").agg(F.count("*").alias("n"))
    return scratch.materialize(_matched(rows, classes, shared, _groups(members, asked, sizes), False), "answers")


def _labels(rows: DataFrame, classes: DataFrame, shared, shares: np.ndarray) -> DataFrame:
    """(node, component) of the classes that are similar to another."""
    ends = _ordered(rows, shared, shares).drop("size")
    mark = F.shiftleft(F.col("size"), 32) + F.size("grams") - 1 - F.col("at")
    entries = classes.join(ends, ["d1", "d2"]).select("class", "size", "grams", F.posexplode("grams").alias("at", "gram"))
    met = scratch.materialize(_stars(entries.select("gram", "class", mark.alias("mark"))), "met")
    # The centres of a split n-gram's groups meet in a group of their own.
    centres = met.filter(F.col("gram").bitwiseAND(F.lit(_SPLIT)) != 0).filter(F.col("gram") > 0)
    centres = centres.filter("class = centre").select(
        F.col("gram").bitwiseAND(F.lit((1 << _RANK_BITS) - 1)).alias("gram"), "class", "mark"
    )
    again = _stars(centres.select(F.col("gram").bitwiseOR(F.lit(1 << 61)).alias("gram"), "class", "mark"))
    # First a class goes to the centre it meets most often, unless their sizes differ too much.
    stars = met.unionByName(again).filter("class != centre").groupBy(
        "class", _size("mark").alias("size"), "centre", _size("centre_mark").alias("centre_size")
    )
    stars = stars.agg(F.count("*").alias("meetings")).filter(
        (F.col("centre_size") * 100 >= F.col("size") * PERCENT) & (F.col("meetings") * HOPE >= _needed("size", "centre_size"))
    )
    first = stars.groupBy("class").agg(F.max_by("centre", F.struct("meetings", -F.col("centre"))).alias("group"))
    first = scratch.materialize(first, "stars")
    sizes = first.groupBy("group").agg(F.count("*").alias("n"))
    probes = sizes.select("group", F.col("group").alias("class"))
    links = scratch.materialize(_matched(rows, classes, shared, _groups(first, probes, sizes), True), "links")
    # Then what is still apart asks the largest component it meets, and at last all that it meets.
    for largest in (True, False):
        labels = components(links)
        links = links.unionByName(_answers(rows, classes, shared, met, labels, largest))
    return components(links)


def _needed(size: str, other: str) -> Column:
    """How many n-grams the ends of two similar sets of these sizes share."""
    overlap = F.ceil(PERCENT * (F.col(size) + F.col(other)) / (100 + PERCENT))
    return overlap - F.ceil(PERCENT * F.greatest(F.col(size), F.col(other)) / 100) + 1


def _order(spark: SparkSession, named: np.ndarray, counts: np.ndarray) -> tuple:
    """Named n-grams with their ranks, for the tasks, and per rank the groups its rows are dealt to.

    At most NAMED + NAMED_AT_ENDS n-grams: 20 MB.
    """
    by_gram = np.argsort(named)
    named, counts = named[by_gram], counts[by_gram]
    order = np.lexsort((named, -counts))
    ranks = np.empty(len(named), np.uint64)
    ranks[order] = np.arange(len(named), dtype=np.uint64)
    shares = np.ones(max(1, len(named)), np.int64)
    shares[: len(named)] = -(-counts[order] // GROUP)
    return spark.sparkContext.broadcast((named, ranks)), shares


def _common_ends(rows: DataFrame, shared) -> tuple[np.ndarray, np.ndarray]:
    """N-grams without a name that many rows have at their sets' rare ends, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, _ = shared.value
        for batch in batches:
            for part in tasks.slices(batch, 1):
                ends = [np.empty(0, np.uint64)]
                for grams in shingle_sets(part.column(1)):
                    if len(grams):
                        at = np.minimum(np.searchsorted(named, grams), max(0, len(named) - 1))
                        rare = grams[named[at] != grams] if len(named) else grams
                        ends.append(rare[-prefix_length(len(grams)) :])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ends).view(np.int64))], names=["gram"])

    counted = rows.mapInArrow(run, "gram bigint").groupBy("gram").agg(F.count("*").alias("n"))
    top = counted.filter(F.col("n") >= OFTEN_AT_ENDS).orderBy(F.desc("n"), "gram").limit(NAMED_AT_ENDS).toArrow()
    return top.column("gram").to_numpy().view(np.uint64), top.column("n").to_numpy()


def linked_components(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Words are runs of bytes other than white space, A-Z lower-cased; a set holds the distinct 5-word
    n-grams, or the whole sequence if there are fewer words.  Sets are compared by 63-bit hashes of the
    n-grams.  Two rows link when 100 * intersection >= 80 * union; a component's id is its smallest key.
    Null texts and texts without a word have an empty set and are linked with nothing.  Equal sets are
    always linked; repeated rows get equal results; null keys take part but name no component; an empty
    table gives no rows; other columns are not read.  Keys are whole numbers.

    Classes that meet under an n-gram are first matched with the centre they meet most often, then with
    the largest component they meet; at last, wherever two components still meet, the classes of the
    smaller one are matched with all of the larger one.  So links inside a component need not be found one
    by one, and none between components is missed.
    """
    kind = df.schema[key].dataType.simpleString()
    return _components(df, key, text).select(
        F.col("key").cast(kind).alias(key),
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "key").cast(kind).alias("component_id"),
    )


def _components(df: DataFrame, key: str, text: str) -> DataFrame:
    """(d1, d2, key, size, component, component_id) of every row; nulls from component on without words."""
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    signed = scratch.materialize(_signed(rows), "signed")
    of_rows = signed.filter("size IS NOT NULL")
    classes = of_rows.filter("size > 0").groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.min("size").alias("size"))
    classes = scratch.materialize(classes, "classes").withColumn("class", F.monotonically_increasing_id())
    classes = scratch.materialize(classes, "classes")
    merged = tasks.tree_merge(signed.filter("counts IS NOT NULL").select("counts"), merge_counts)
    named, counts = _unpack(merged) if merged else (np.empty(0, np.uint64), np.empty(0, np.int64))
    named, counts = named[counts >= OFTEN], counts[counts >= OFTEN]
    shared, shares = _order(spark, named, counts)
    more, seen = _common_ends(rows, shared)
    shared, shares = _order(spark, np.concatenate([named, more]), np.concatenate([counts, seen]))

    labels = _labels(rows, classes, shared, shares)
    joined = classes.join(labels, F.col("class") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    lowest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    final = joined.join(lowest, "component").select("d1", "d2", "component", "component_id")
    return of_rows.join(final, ["d1", "d2"], "left").select("d1", "d2", "key", "size", "component", "component_id")


def _with_digests(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the digests of its rows' sets as ``set d1`` and ``set d2``, null without words."""
    at = df.columns.index(text)
    names = [*df.columns, "set d1", "set d2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tasks.slices(batch, at):
                texts = part.column(at).cast(pa.string())
                digests = [_digest(s) if len(s) else (None, None) for s in shingle_sets(texts)]
                added = [pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, `set d1` bigint, `set d2` bigint")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without those whose component has a smaller key, columns unchanged.

    Of a component's rows with the smallest key one stays, so of repeated rows too; rows of one key and
    different texts are judged each by their text.  Rows with a null key or without a word all stay; an
    empty table stays empty.  Only rows that a filter of fixed size can't tell apart from others' copies
    are shuffled.
    """
    found = scratch.materialize(
        _components(df, key, text).filter("size > 0 AND key IS NOT NULL").drop("size"), "components"
    )
    copies = found.groupBy("key").agg(F.min("component_id").alias("first"), F.count("*").alias("n"))
    copies = copies.filter((F.col("key") != F.col("first")) | (F.col("n") > 1))
    copies = scratch.materialize(copies.select(F.col("key").alias(key), "first", "n"), "copies")
    seen = df.sparkSession.sparkContext.broadcast(tasks.membership(copies.select(F.col(key).cast("bigint"))))
    named = [*df.columns]

    def split(flagged: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        at = named.index(key)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                maybe = seen.value[tasks.filter_bits(keys)] & ~batch.column(at).is_null().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(maybe == flagged))

        return run

    sure = df.mapInArrow(split(False), df.schema)
    unsure = df.mapInArrow(split(True), df.schema)
    single = unsure.join(copies.select(key), key, "anti").select(*named)
    # Rows that share a key are told apart by their sets: those go that have a copy with a smaller key.
    shared = unsure.join(copies.filter("n > 1").select(key), key, "semi").select(*named)
    digested = _with_digests(shared, text)
    wordless = digested.filter(F.col("set d1").isNull()).select(*named)
    firsts = found.filter("key = component_id").select(
        F.col("key").alias(key), F.col("d1").alias("set d1"), F.col("d2").alias("set d2"), F.col("component").alias("set component")
    )
    once = digested.join(firsts.distinct(), [key, "set d1", "set d2"]).dropDuplicates([key, "set component"])
    return reduce(DataFrame.unionByName, [sure, single, wordless, once.select(*named)])
