import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mercato.llm import variants as operator
from mercato.llm.variants import near_words, single_edits, slipped, variants
from tests.llm.helpers import documents, gathered


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    found = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(found, key=repr)


def misspelt(rng, word):
    at = rng.randrange(len(word))
    return word[:at] + rng.choice(["", "x", "é", "ab"]) + word[at + rng.choice((0, 1)) :]


@pytest.mark.parametrize("group", [2, 384])
def test_equals_brute_force(spark, monkeypatch, group):
    """Chains of forms, ties, and halves that are halved again when few words may share one."""
    monkeypatch.setattr(operator, "GROUP", group)
    rng = random.Random(4)
    stems = ["straße", "banana", "aaaaaaa", "aaaaaaaa", "separate", "ÀÉîøþÿa", "counterrevolution"]
    bag = []
    for stem in stems:
        bag += [stem] * 900
        for _ in range(12):
            first = misspelt(rng, stem)
            bag += [first] * rng.choice((5, 20, 60)) + [misspelt(rng, first)] * 5
    rng.shuffle(bag)
    rows = [(i, " ".join(bag[i * 40 : i * 40 + 40])) for i in range(-(-len(bag) // 40))]
    rows += [(None, "separate Separate SEPARATE"), (3, None), (4, ""), (5, "12 ß ÷×"), rows[0], rows[0]]
    rows += [(6, "z" * 3_000 + " ") , (7, " ".join(["q" * 2_000, "q" * 1_999] * 5))]
    expected = brute(rows)
    assert any(r[2] not in (r[0], r[1]) for r in expected)
    found = variants(documents(spark, rows, "word n form").repartition(3))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert gathered(found) == expected


def test_no_words(spark):
    assert variants(documents(spark, [])).count() == 0
    assert variants(documents(spark, [(1, None), (2, "short words only")])).count() == 0
    with pytest.raises(ValueError):
        variants(documents(spark, []), times=1)


def test_runs_lose_a_code_point_by_checksum():
    lost = [k for k in range(1_000) if slipped(str(k), "banana") != "banana"]
    assert lost and all(zlib.crc32(f"{k}:banana".encode()) % 199 == 0 for k in lost)
    assert all(len(slipped(str(k), "banana")) == 5 for k in lost)


def test_every_pair_is_met_once(spark, monkeypatch):
    """All words of few letters: every half is crowded."""
    monkeypatch.setattr(operator, "GROUP", 4)
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 9))) for _ in range(400)})
    expected = sorted((a, b, 7) for a in words for b in words if one_edit(a, b))
    rows = spark.createDataFrame([(w, 7) for w in words], "word string, n bigint").repartition(4)
    assert gathered(near_words(rows)) == sorted(expected, key=repr)


@pytest.mark.parametrize("tile", [3, 256])
def test_tiles_find_single_edits(monkeypatch, tile):
    monkeypatch.setattr(operator, "TILE", tile)
    rng = random.Random(2)
    every = sorted({"".join(rng.choice("aé") for _ in range(rng.randint(6, 8))) for _ in range(160)})
    for longest in (7, 8):
        words = [w for w in every if len(w) in (longest, longest - 1)]
        of, under = np.zeros(len(words), np.int64), np.full(len(words), 2**31 - 1)
        i, j = single_edits(words, of, longest, under)
        expected = {
            (a, b)
            for a in range(len(words))
            for b in range(a + 1, len(words))
            if one_edit(words[a], words[b]) and max(len(words[a]), len(words[b])) == longest
        }
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(expected)
