import math
import random

import numpy as np
import pytest

from mercato.llm import negatives as operator
from mercato.llm.negatives import Block, Codes, Queries, hard_negatives, products, rotated
from tests.llm.helpers import gathered

SCHEMA = "vec_id bigint, embedding array<double>, label int, score int, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows, every=50):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    found = []
    for a, (i, v, label) in enumerate(kept):
        if i % every:
            continue
        others = [
            (-sum(x * y for x, y in zip(v, w)), j, m) for b, (j, w, m) in enumerate(kept) if b != a and len(w) == len(v)
        ]
        others.sort()
        for s, j, _ in [o for o in others if o[2] == label][:5]:
            between = [o for o in others if o[2] != label and 50 * -s <= 100 * -o[0] <= 95 * -s][:3]
            found += [(i, j, rank, n, -s, -t) for rank, (t, n, _) in enumerate(between, 1)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("bytes_, cells", [(1 << 20, 1 << 19), (3_000, 50)])
def test_equals_brute_force(spark, monkeypatch, bytes_, cells):
    """Ties, repeated rows, unusable rows, other widths; many tiles and blocks as well as one."""
    monkeypatch.setattr(operator, "BLOCK_BYTES", bytes_)
    monkeypatch.setattr(operator, "TILE_BYTES", bytes_)
    monkeypatch.setattr(operator, "CELLS", cells)
    rng = random.Random(6)
    rows = [(i, [rng.choice((-1.0, 0.0, 0.5, 1.0, 1.3)) for _ in range(7)], rng.randrange(4)) for i in range(400)]
    rows += [(i, [rng.uniform(0, 1) for _ in range(7)], i % 3) for i in range(400, 700)]
    rows += [rows[50], rows[50], rows[3], rows[3]] + [(777, rows[100][1], 2)] * 60
    rows += [(None, [1.0] * 7, 1), (50, None, 1), (100, [1.0] * 7, None), (150, [None] * 7, 1)]
    rows += [(200, [float("nan")] * 7, 1), (250, [float("inf")] * 7, 1), (300, [0.0] * 7, 2)]
    rows += [(350 + i, [1.0, 0.8 + i / 1_000], i % 2) for i in range(60)] + [(1_000, [], 1), (1_050, [], 2)]
    expected = brute(rows)
    assert expected
    assert gathered(hard_negatives(table(spark, rows).repartition(3))) == expected


def test_large_numbers_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice((1.0, 1.1, 0.9)) * 10**6 for _ in range(5)], i % 2) for i in range(120)]
    assert gathered(hard_negatives(table(spark, rows))) == brute(rows)


def test_nothing_to_mine(spark):
    assert hard_negatives(table(spark, [])).count() == 0
    assert hard_negatives(table(spark, [(50, [1.0], 1)])).count() == 0
    assert hard_negatives(table(spark, [(50, [1.0], 1), (51, [1.0], 1)])).count() == 0


@pytest.mark.parametrize("width", [1, 3, 64, 65, 200])
def test_intervals_hold_every_product(width):
    rng = np.random.default_rng(width)
    rows = rng.integers(-300, 300, (150, width)).astype(float)
    rows[3], rows[4] = 0, rows[5]
    anchors = np.concatenate([rows[:20], rng.integers(-9, 9, (10, width)).astype(float), np.zeros((1, width))])
    low, high = Queries(anchors).intervals(slice(None), Codes.of(rows))
    exact = anchors @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    lengths = np.linalg.norm(anchors, axis=1)[:, None] * np.linalg.norm(rows, axis=1)
    assert (high - low <= 1.2 * lengths + 1).all()


def test_rotation_keeps_products():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(4, 70)), rng.normal(size=(5, 70))
    assert np.allclose(rotated(a) @ rotated(b).T, a @ b.T)


def test_blocks_travel_whole():
    for most in (100, 10**5, 10**12):
        vectors = np.array([[most, -most, 0.0], [1, 2, 3]])
        block = Block.of((1, 2), (5, 6), (0, 9), vectors)
        back = Block.unpack(block.pack())
        assert back.ids.tolist() == [5, 6] and back.labels.tolist() == [0, 9] and back.turns.tolist() == [1, 2]
        assert (back.vectors == vectors).all()
        assert (back.codes.signs == block.codes.signs).all() and (back.codes.rest == block.codes.rest).all()


def test_products_beyond_doubles():
    a = np.array([[3.0e9, 1.0], [2.0, 5.0]])
    assert products(a, a).tolist() == [9 * 10**18 + 1, 29]
