import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mercato.llm import packing
from mercato.llm.packing import best_fit, local_search, pack
from mercato.llm.queries import VOCABULARY
from tests.llm.helpers import documents


def check(rows, found, capacity=2_048):
    """Every token of every row lies at one place; returns the number of sequences."""
    library = Tokenizer.from_file(VOCABULARY)
    expected = []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)] if len(ids) > capacity else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((key, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    got = found.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in got)


@pytest.mark.parametrize("block", [20, 8_192])
def test_every_token_is_placed_once(spark, monkeypatch, block):
    """Many blocks need further rounds for what stays underfull; the packing is tight all the same."""
    monkeypatch.setattr(packing, "BLOCK", block)
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(("the", "of", "words", "naïve")) for _ in range(rng.randint(0, 1_500)))) for i in range(150)]
    rows += [(None, "no key"), (7, None), (8, ""), (9, "a b " * 9_000), (3, rows[3][1]), (3, rows[3][1])]
    bins, tokens = check(rows, pack(documents(spark, rows, "offset piece").repartition(3), VOCABULARY))
    assert bins <= -(-tokens // 2_048) * 1.05 + 1


def test_nothing_to_pack(spark):
    assert pack(documents(spark, []), VOCABULARY).count() == 0
    assert check([(1, None)], pack(documents(spark, [(1, None)]), VOCABULARY)) == (1, 1)


def test_exchanges_empty_a_bin():
    """7 + 7, 6 + 6 + 6 and so on: best fit leaves gaps that only exchanges close."""
    sizes = [7, 7, 6, 6, 6, 4, 4, 4, 4, 2, 10]
    start = [[0, 2], [1, 3], [4, 5, 6], [7, 8, 9], [10]]
    packed = local_search([list(b) for b in start], sizes, 20)
    assert sorted(i for b in packed for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 20 for b in packed) and len(packed) < len(start)


def test_search_never_needs_more_bins():
    rng = random.Random(5)
    for low, high in ((1, 100), (20, 60), (30, 40), (45, 55)):
        sizes = [rng.randint(low, high) for _ in range(300)]
        start = best_fit(sizes, 100)
        packed = local_search([list(b) for b in start], sizes, 100)
        assert sorted(i for b in packed for i in b) == list(range(300))
        assert all(sum(sizes[i] for i in b) <= 100 for b in packed) and len(packed) <= len(start)


# (fullest bin, other bin) at a capacity of 100: taken are two of 4 for one of 7, or one of 8 is taken for two of 3.
PAIRS = (
    ([7] + [4] * 23, [4] * 20),
    ([3] * 33, [7] * 2 + [8] * 4),
)


def test_bins_of_many_documents_exchange_pairs():
    """Only two documents for one close the gap."""
    for few, many in PAIRS:
        sizes = few + many
        search = packing._Search([list(range(len(few))), list(range(len(few), len(sizes)))], sizes, 100)
        assert search.improve(0)
        assert sorted(i for b in search.bins for i in b) == list(range(len(sizes)))
        assert max(sum(sizes[i] for i in b) for b in search.bins) == 100


def test_pairs_have_every_sum():
    rng = random.Random(3)
    for _ in range(200):
        sizes = [rng.randint(1, 12) for _ in range(rng.randint(0, 40))]
        items = rng.sample(range(len(sizes)), rng.randint(0, len(sizes)))
        every = {sizes[i] + sizes[j] for n, i in enumerate(items) for j in items[n + 1 :]}
        pairs = packing._pairs(items, sizes)
        assert set(pairs) == every
        assert all(i != j and {i, j} <= set(items) and sizes[i] + sizes[j] == a for a, (i, j) in pairs.items())


def raises_squared_fill(bins, sizes, capacity):
    """Whether any move, one-for-one or two-for-one exchange of two bins does, tried one by one."""
    parts = [[()] + [(i,) for i in b] + [(i, j) for n, i in enumerate(b) for j in b[n + 1 :]] for b in bins]
    fills = [sum(sizes[i] for i in b) for b in bins]
    for a in range(len(bins)):
        for b in range(len(bins)):
            for give in parts[a] if a != b and fills[a] < capacity and fills[b] < capacity else ():
                for take in parts[b]:
                    gain = sum(sizes[i] for i in take) - sum(sizes[i] for i in give)
                    into, left = fills[a] + gain, fills[b] - gain
                    if not (len(give) == len(take) == 2) and 0 < gain and into <= capacity:
                        if into**2 + left**2 > fills[a] ** 2 + fills[b] ** 2:
                            return True
    return False


@pytest.mark.parametrize("low, high", [(1, 30), (20, 60), (30, 40), (35, 45)])
def test_search_ends_where_no_exchange_helps(low, high):
    rng = random.Random(low)
    for _ in range(15):
        sizes = [rng.randint(low, high) for _ in range(24)]
        packed = local_search(best_fit(sizes, 100), sizes, 100)
        fewest = -(-sum(sizes) // 100)
        assert len(packed) == fewest or not raises_squared_fill(packed, sizes, 100)


@pytest.mark.parametrize("low, high", [(600, 800), (500, 1_000), (300, 700), (1, 2_000)])
def test_searching_again_changes_nothing(low, high):
    rng = random.Random(high)
    sizes = [rng.randint(low, high) for _ in range(2_000)]
    start = best_fit(sizes, 2_048)
    once = local_search(start, sizes, 2_048)
    assert len(once) <= len(start) - (len(start) // 25 if low > 300 else 0)
    assert sorted(map(sorted, local_search(once, sizes, 2_048))) == sorted(map(sorted, once))


def fewest(sizes, capacity):
    """The least number of bins, by trying everything."""
    best = len(sizes)

    def place(at, gaps):
        nonlocal best
        if len(gaps) >= best:
            return
        if at == len(sizes):
            best = len(gaps)
            return
        for n, gap in enumerate(gaps):
            if gap >= sizes[at] and gap not in gaps[:n]:
                place(at + 1, [*gaps[:n], gap - sizes[at], *gaps[n + 1 :]])
        place(at + 1, [*gaps, capacity - sizes[at]])

    place(0, [])
    return best


def test_near_the_fewest_bins():
    """Against an exhaustive packing: seldom one bin more, never two."""
    rng = random.Random(9)
    more = []
    for _ in range(60):
        sizes = sorted((rng.randint(15, 60) for _ in range(11)), reverse=True)
        more.append(len(local_search(best_fit(sizes, 100), sizes, 100)) - fewest(sizes, 100))
    assert max(more) <= 1 and sum(more) <= 6
