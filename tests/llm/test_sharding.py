import zlib

import pytest
from pyspark.sql import functions as F

from mercato.llm import sharding
from mercato.llm.sharding import sharded, write_shards
from tests.llm.helpers import documents


def check(rows, found, shards):
    got = found.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(rows, key=repr)
    for r in got:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
    by_shard = {}
    for r in got:
        assert 0 <= r.shard < shards
        by_shard.setdefault(r.shard, []).append(r)
    for members in by_shard.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    return by_shard


@pytest.mark.parametrize("cell_rows", [50, 200_000])
def test_shards_are_near_equal(spark, monkeypatch, cell_rows):
    """A third of all rows has the same text: the group is split, its rows are neighbours."""
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    rows = [(i, "same text " * 3 if i % 3 == 0 else f"text {i} " * (1 + i % 17)) for i in range(4_000)]
    by_shard = check(rows, sharded(documents(spark, rows, "shard slot").repartition(5), shards=8), 8)
    sizes = [sum(r.size for r in members) for members in by_shard.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * max(len(t) + 16 for _, t in rows)
    holders = sorted(s for s, members in by_shard.items() if any(r.doc_id % 3 == 0 for r in members))
    assert holders == list(range(holders[0], holders[-1] + 1))


def test_awkward_rows(spark):
    rows = [(None, "a"), (1, None), (2, ""), (3, "é" * 10_000), (4, "x"), (4, "x"), (4, "x")]
    check(rows, sharded(documents(spark, rows)), 40)
    assert sharded(documents(spark, [])).count() == 0
    check([(1, "one")], sharded(documents(spark, [(1, "one")])), 40)


def test_places_do_not_depend_on_the_counting(spark, monkeypatch):
    """Counted keys agree with the rows: no row lies on the wrong side of a splitter."""
    rows = [(i, f"text {i % 700}") for i in range(2_000)]
    monkeypatch.setattr(sharding, "PROBES", 6)
    by_shard = check(rows, sharded(documents(spark, rows), shards=5), 5)
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 40


def test_shards_are_written(spark, tmp_path):
    write_shards(documents(spark, [(i, f"text {i}") for i in range(200)]), f"{tmp_path}/shards", shards=4)
    table = spark.read.parquet(f"{tmp_path}/shards")
    assert table.count() == 200 and table.select(F.countDistinct("shard")).first()[0] == 4
