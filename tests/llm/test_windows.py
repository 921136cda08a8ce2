import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from mercato.llm import windows as operator
from mercato.llm.codec import Codec
from mercato.llm.queries import VOCABULARY
from mercato.llm.windows import INSIDE, SENTENCE, SEQUENCE, Pauses, best_cuts, windows
from tests.llm.helpers import documents


def padding(length, capacity):
    return 0 if length & (length - 1) == 0 else capacity - length


def check(rows, found, capacity=2_048):
    """Every id of every row lies at one place of one sequence; returns their lengths."""
    library = Tokenizer.from_file(VOCABULARY)
    left = {}
    for key, text in rows:
        left.setdefault(key, []).append([*library.encode(text or "", add_special_tokens=False).ids, 1])
    got = found.collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    expected = {}
    for key, texts in left.items():
        for ids in texts:
            expected.setdefault((key, len(ids)), []).append(ids)
    assert set(pieces) == set(expected)
    for name, parts in pieces.items():
        copies = expected[name]
        assert sum(p[1] for p in parts) == sum(map(len, copies))
        for start, length, crc in parts:
            assert any(zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes()) == crc for ids in copies)
        if len(copies) == 1:
            at = 0
            for start, length, _ in sorted(parts):
                assert start == at
                at += length
    lengths = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("block", [300, 1 << 18])
def test_every_id_is_placed_once(spark, monkeypatch, block):
    monkeypatch.setattr(operator, "BLOCK", block)
    rng = random.Random(2)
    words = ("The", "words", "of. It", "naïve", 'said "so!" And', "数据。", "\n\n")
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 900)))) for i in range(120)]
    rows += [(None, "no key"), (7_000, None), (8_000, ""), (9_000, "a b " * 9_000), (3, rows[3][1]), (3, rows[3][1])]
    rows += [(9_001, "<|endoftext|> in a text. " * 40), (9_002, "x" * 30_000)]
    found = windows(documents(spark, rows, "start offset length").repartition(2), VOCABULARY, capacity=256)
    lengths = check(rows, found, 256)
    assert sum(padding(n, 256) for n in lengths) <= 0.08 * sum(lengths)


def test_given_documents_need_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    lengths = check(rows, windows(df, VOCABULARY))
    assert sum(padding(n, 2_048) for n in lengths) <= 0.01 * sum(lengths)
    assert len(lengths) <= 1.02 * -(-sum(lengths) // 2_048) + 1


def test_nothing_to_pack(spark):
    assert windows(documents(spark, []), VOCABULARY).count() == 0
    assert check([(1, None)], windows(documents(spark, [(1, None)]), VOCABULARY)) == [1]
    with pytest.raises(ValueError):
        windows(documents(spark, []), VOCABULARY, capacity=8)


def test_documents_stay_in_order(spark):
    rows = [(i, "A sentence of some words. " * (i % 60)) for i in range(200)]
    found = windows(documents(spark, rows).coalesce(1), VOCABULARY).orderBy("sequence_id", "offset").collect()
    assert [(r.doc_id, r.start) for r in found] == sorted((r.doc_id, r.start) for r in found)


def least(places, penalties, capacity):
    """The cost of the best way, from every pair of places."""
    cost = {0: 0}
    for place, penalty in zip(places, penalties):
        cost[place] = penalty + SEQUENCE + min(
            cost[p] + padding(place - p, capacity) for p in cost if place - p <= capacity
        )
    return cost[places[-1]]


@pytest.mark.parametrize("capacity", [32, 48, 100])
def test_cuts_are_the_cheapest(capacity):
    rng = random.Random(capacity)
    for _ in range(300):
        places = np.cumsum([rng.randint(1, capacity // 3) for _ in range(rng.randint(1, 60))]).tolist()
        penalties = [rng.choice((0, 0, SENTENCE, INSIDE)) for _ in places]
        given = np.array(places), np.array(penalties)
        cuts = best_cuts(*given, capacity)
        assert cuts[-1] == places[-1]
        worth = dict(zip(places, penalties))
        steps = list(zip([0, *cuts], cuts))
        assert all(0 < b - a <= capacity for a, b in steps)
        assert sum(worth[b] + SEQUENCE + padding(b - a, capacity) for a, b in steps) == least(places, penalties, capacity)
        open_end = best_cuts(*given, capacity, last=False)
        assert places[-1] - open_end[-1] < capacity


def test_sentences_end_where_they_should():
    coder = Codec(VOCABULARY)
    pauses = Pauses([coder.fast.decode_single_token_bytes(i) for i in range(len(coder.widths))])
    text = 'One. Two e.g. this one? "Three!" Four at 3.5 cm.\n\nFive。Six'
    ids = np.frombuffer(coder.encode([text])[0], "<u4")
    ends = np.flatnonzero(pauses.after(ids)) + 1
    parts = [coder.fast.decode(ids[a:b].tolist()) for a, b in zip([0, *ends], [*ends, len(ids)])]
    assert parts == ["One.", " Two e.g. this one?", ' "Three!"', " Four at 3.5 cm.\n\n", "Five。", "Six"]
