import random

import numpy as np
import pytest

from mercato.llm import decontaminate, tasks
from mercato.llm.decontaminate import contaminated_spans, cut, decontaminated, suffix_array
from tests.llm.helpers import benchmark_words, documents


def brute(rows, items):
    windows = {}
    for key, text in items:
        w = benchmark_words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([] if key is None else [str(key)])
    out = []
    for key, text in rows:
        w, hit, names = benchmark_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        out.append((key, len(w), sorted(hit), sorted(names)))
    return sorted(out, key=repr)


def case(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(rng.choice((3, 6, 50)))] + ["É", "ab1"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice((0, 9, 10, 11, 30))))) for i in range(8)]
    items += [(None, "no key"), (11, None), (12, items[0][1]), (13, "w1 w2")]
    rows = [(None, items[1][1]), (1, None), (2, ""), (3, "...")]
    for i in range(25):
        text = rng.choice((" ", "\n", ", ")).join(rng.choice([*words, "x", "y"]) for _ in range(rng.choice((1, 5, 60))))
        rows.append((10 + i, f"{text} {rng.choice(items[:8])[1].upper()} {text}"))
    return [*rows, rows[5], rows[5]], items


@pytest.mark.parametrize("seed, shard, block", [(1, 1, 1 << 20), (2, 500, 1 << 20), (3, 1 << 22, 40), (4, 1 << 22, 1 << 20)])
def test_hits_equal_brute_force(spark, monkeypatch, seed, shard, block):
    """Shards of one row, of some and of all; a benchmark that needs several passes."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "PASS_WINDOWS", block)
    rows, items = case(seed)
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = contaminated_spans(documents(spark, rows, "spans items").repartition(2), benchmark, ["doc_id"])
    got = [
        (r.doc_id, r.n_words, [k for s in r["spans"] for k in range(s.start, s.end)], list(r["items"]))
        for r in found.collect()
    ]
    assert sorted(got, key=repr) == brute(rows, items)


def test_without_documents_or_benchmark(spark):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert contaminated_spans(documents(spark, []), some, ["doc_id"]).count() == 0
    row = contaminated_spans(documents(spark, [(1, "a b c")]), nothing, ["doc_id"]).collect()[0]
    assert (row.n_words, row["spans"], row["items"]) == (3, [], [])


def test_words_across_steps(monkeypatch):
    """Hashes do not depend on where a long text is cut."""
    import pyarrow as pa

    data = tasks.flat(pa.array(["ab cdefgh i", None, "", "ijk", "lm" * 40 + " ab"]))
    tables = (decontaminate.LOWER, decontaminate.WORD)
    whole = tasks.word_hashes(*data, *tables)
    monkeypatch.setattr(tasks, "STEP_BYTES", 3)
    again = tasks.word_hashes(*data, *tables)
    assert all((a == b).all() for a, b in zip(whole, again))
    assert whole[1].tolist() == [0, 3, 3, 3, 4, 6] and whole[0][0] == whole[0][5]


def test_suffixes_are_sorted():
    rng = np.random.default_rng(1)
    for top in (2, 5, 300):
        text = np.append(rng.integers(1, top, 400), 0)
        suffixes = [text[i:].tolist() for i in suffix_array(text)]
        assert suffixes == sorted(suffixes)


def test_phrases_are_cut_out(spark):
    assert cut("One, two three! Four", [{"start": 1, "end": 3}]) == "One, ! Four"
    benchmark = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    rows = [(1, "One, two three! Four"), (2, "two THREE"), (3, "clean text"), (4, None), (5, "...")]
    frame = documents(spark, rows, "spans n_words row")
    kept = decontaminated(frame, benchmark)
    assert kept.columns == frame.columns
    found = {r.doc_id: (r.text, r.n_chars) for r in kept.collect()}
    assert found == {1: ("One, ! Four", 11), 3: ("clean text", 10), 4: (None, 0), 5: ("...", 3)}
