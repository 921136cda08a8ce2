import random

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm import jaccard, tasks
from mercato.llm.components import components
from mercato.llm.jaccard import Trie, linked_components, one_of_each, shingle_sets
from tests.llm.helpers import documents, gathered, white_space_words


def brute(rows):
    sets = []
    for _, text in rows:
        w = white_space_words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    keys = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return sorted(((k, len(s), keys[g] if s else k) for (k, _), s, g in zip(rows, sets, group)), key=repr)


def copies(seed, words=300):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passage = [rng.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 5, 8, 40, 80, 120)))]
        for _ in range(rng.choice((1, 1, 2, 5, 15))):
            text = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 5))):
                text.insert(rng.randrange(len(text) + 1), rng.choice(vocabulary))
            rows.append((len(rows), rng.choice((" ", "\n")).join(text + passage * (rng.random() < 0.3))))
    rows += [(None, rows[0][1]), (700, None), (701, ""), (702, " \t"), rows[5], rows[5], (900, rows[9][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("small", [True, False])
def test_components_equal_brute_force(spark, monkeypatch, small):
    """Small limits: frequent n-grams are named early, their groups split, tries hold few sets."""
    if small:
        for name, value in (("OFTEN", 6), ("GROUP", 5), ("TRIE_SETS", 4), ("OFTEN_AT_ENDS", 4)):
            monkeypatch.setattr(jaccard, name, value)
    rows = copies(3)
    found = linked_components(documents(spark, rows, "size component class").repartition(3))
    assert gathered(found) == brute(rows)


def test_one_of_each_group_stays(spark):
    rows = copies(4)
    frame = documents(spark, rows)
    kept = one_of_each(frame.repartition(2))
    assert kept.columns == frame.columns
    expected = {k for k, _, c in brute(rows) if k == c}
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(expected)


def test_no_documents(spark):
    assert linked_components(documents(spark, [])).count() == 0
    assert gathered(linked_components(documents(spark, [(1, None)]))) == [(1, 0, 1)]
    assert one_of_each(documents(spark, [])).count() == 0


def test_trie_finds_what_is_similar():
    import numpy as np
    import pyarrow as pa

    sets = [(i, s) for i, s in enumerate(shingle_sets(pa.array([t for _, t in copies(5)]))) if len(s)]
    trie = Trie.of(sets)
    for _, probe in sets:
        expected = {
            n for n, s in sets if 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))
        }
        assert set(trie.similar(probe)) == expected


def test_long_chains_are_one_component(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    found = dict(gathered(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}


def test_rows_of_one_key_are_judged_by_their_text(spark):
    """A repeated id's clean text stays when another text of the id has a copy with a smaller one."""
    words = [f"w{i}" for i in range(200)]
    first, second, third = (" ".join(words[a : a + 40]) for a in (0, 60, 120))
    rows = [(1, first), (5, first), (5, second), (5, second), (5, ""), (5, None), (7, third), (7, first), (9, second + " end")]
    rows += [(None, first), (None, first)]
    kept = one_of_each(documents(spark, rows, "key d1").repartition(3))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    expected = [(1, first), (5, second), (5, ""), (5, None), (7, third), (None, first), (None, first)]
    assert got == sorted(expected, key=repr)
    assert one_of_each(documents(spark, [])).count() == 0


def test_sets_are_made_of_wanted_rows_only(spark):
    """A second look at the texts makes the sets of rows with a wanted key, and of those without any."""
    rows = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (None, "g h i"), (3, "j k l")], "key bigint, text string")
    shared, _ = jaccard._order(spark, np.empty(0, np.uint64), np.empty(0, np.int64))
    wanted = spark.sparkContext.broadcast(tasks.membership(rows.filter("key = 2").select("key")))
    found = jaccard._ordered(rows, shared, None, wanted).collect()
    expected = [jaccard._digest(s) for s in shingle_sets(pa.array(["d e f", "g h i"]))]
    assert sorted((r.d1, r.d2) for r in found) == sorted(expected)


def test_texts_without_a_key_link_others(spark):
    """The only text between two others has no key, and comes twice."""
    words = [f"w{i}" for i in range(104)]
    between = (None, " ".join(words[:100]))
    rows = [(5, " ".join([*words[:100], "x1", "x2", "x3"])), between, between, (9, " ".join(words[8:100])), (7, "x y")]
    assert gathered(linked_components(documents(spark, rows))) == brute(rows)


@pytest.mark.parametrize("counted", [20, 2000])
def test_rows_counted_as_they_came(spark, monkeypatch, counted):
    """A task whose last rows fill its store of n-grams has nothing left to count at its end."""
    monkeypatch.setattr(jaccard, "COUNTED", counted)
    monkeypatch.setattr(jaccard, "OFTEN", 6)
    rows = copies(6)
    expected = brute(rows)
    frame = documents(spark, rows).coalesce(1)
    assert gathered(linked_components(frame)) == expected
    ids = [r.doc_id for r in one_of_each(frame).collect() if r.doc_id is not None]
    assert sorted(ids) == sorted({k for k, _, c in expected if k == c})
