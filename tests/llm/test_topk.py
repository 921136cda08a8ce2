import math
import random

import pytest

from mercato.llm import topk
from mercato.llm.topk import nearest

SHAPE = "vec_id bigint, embedding array<double>, rank int"


def brute(rows, every=5, k=20):
    usable = [
        (i, key, [math.floor(64.0 * x) for x in v])
        for i, (key, v, _) in enumerate(rows)
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, key, q in usable:
        if key % every == 0:
            found = [(-sum(a * b for a, b in zip(q, v)), other) for j, other, v in usable if j != i and len(v) == len(q)]
            found = sorted((s, o) for s, o in found)[:k]
            out += [(key, rank, o, -s) for rank, (s, o) in enumerate(found, 1)]
    return sorted(out)


def vectors(seed, n=150):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((rng.uniform(-2, 2), 0.5, -0.01)) for _ in range(6)], 1) for i in range(n)]
    rows += [(200, rows[3][1], 1), (205, rows[5][1], 1), (205, rows[5][1], 1), (210, [1.0, 2.0], 1), (211, [3.0, 1.0], 1)]
    rows += [(None, rows[1][1], 1), (215, None, 1), (220, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (225, [float("nan")] * 6, 1)]
    rows += [(230, [float("inf")] * 6, 1), (235, [], 1), (240, [], 1)]
    return rows


@pytest.mark.parametrize("shard, tile, fan_in", [(8_192, 4_096, 16), (10, 3, 2), (40, 16, 3)])
def test_lists_equal_brute_force(spark, monkeypatch, shard, tile, fan_in):
    """One shard, and many with merges over several levels; ties, copies, odd vectors, other lengths."""
    for name, value in (("SHARD", shard), ("CORPUS_TILE", tile), ("QUERY_TILE", 7), ("FAN_IN", fan_in)):
        monkeypatch.setattr(topk, name, value)
    rows = vectors(shard)
    found = nearest(spark.createDataFrame(rows, SHAPE).repartition(3), every=5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**30, 3.0], 1), (1, [2.0**14 + 1, -1.0], 1), (2, [2.0**14, 5.0], 1)]
    found = nearest(spark.createDataFrame(rows, SHAPE), every=5)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_few_or_no_vectors(spark):
    assert nearest(spark.createDataFrame([], SHAPE)).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0], 1)], SHAPE)).count() == 0
