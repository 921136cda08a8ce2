import os
import re
import shutil
import subprocess
import sys

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from mercato import scratch
from mercato.llm import jaccard
from mercato.llm.pii import base_spans
from mercato.session import BATCH_SETTING
from tests.conftest import SF
from tests.llm.helpers import benchmark_words, documents, white_space_words
from tests.llm.test_decontaminate import brute as decontamination
from tests.llm.test_jaccard import brute as near_copies
from tests.llm.test_jaccard import copies
from tests.llm.test_packing import check

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_take_effect(spark):
    """Each stage against a plain version, on what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept.get("docs") or [tuple(r) for r in docs.collect()]
        result = scratch.materialize(stage(spark, docs, SF), name)
        if name == "best_fit_packing":
            check([(i, t) for i, t, *_ in before], result)
            break
        assert result.columns == columns
        after = [tuple(r) for r in result.collect()]
        rows = {r[0]: r for r in after}
        if name == "language_id":
            lettered = {r[0] for r in before if r[1] and any(c.isalpha() for c in r[1])}
            assert set(rows) == lettered and all(rows[r[0]] == r for r in before if r[0] in rows)
        elif name == "jaccard_join":
            expected = {k for k, _, c in near_copies([(r[0], r[1]) for r in before]) if k == c}
            assert set(rows) == expected and len(after) == len(rows) < len(before)
            assert all(rows[r[0]] == r for r in before if r[0] in rows)
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            hits = {k: hit for k, _, hit, _ in decontamination([(r[0], r[1]) for r in before], items)}
            assert any(hits.values())
            for r in before:
                left = [w for i, w in enumerate(benchmark_words(r[1])) if i not in set(hits[r[0]])]
                if not hits[r[0]]:
                    assert rows[r[0]] == r
                elif left:
                    assert benchmark_words(rows[r[0]][1]) == left and rows[r[0]][4] == len(rows[r[0]][1])
                else:
                    assert r[0] not in rows
        elif name == "personal_data":
            assert [r[0] for r in sorted(after)] == [r[0] for r in sorted(before)]
            for r in before:
                assert not base_spans(rows[r[0]][1])
                if not re.search("[0-9@]", r[1]):
                    assert rows[r[0]] == r
                elif base_spans(r[1]):
                    assert white_space_words(rows[r[0]][1]) != white_space_words(r[1])
        docs, kept["docs"] = result, after


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, SF).columns[-2:] == ["sequence_id", "offset"]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id",
        "jaccard_join",
        "decontamination",
        "personal_data",
        "best_fit_packing",
    ]


def test_workers_get_small_batches(spark):
    """A stage bounds the bytes of a batch; the number of rows alone would let one hold gigabytes."""
    spark.conf.unset(BATCH_SETTING)
    corpus_pipeline.decontamination(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["size"])

    wide = spark.range(0, 48, 1, 1).select(F.repeat(F.lit("x"), F.lit(1 << 18)).alias("text"))
    found = [r["size"] for r in wide.mapInArrow(sizes, "size bigint").collect()]
    assert sum(found) > 10 << 20 and max(found) < 4 << 20


def test_copies_go_where_a_task_ends_with_its_store_full(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COUNTED", 50)
    rows = copies(8)
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, documents(spark, rows).coalesce(2), SF)
    found = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert found == sorted({k for k, _, c in near_copies(rows) if k is not None and k == c})


def test_awkward_tables(spark, tmp_path):
    """Nulls in any column, repeated rows, one id with two texts, a long text, columns named like results."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    text = "the quiet words of a text that nobody else has written before today or since"
    other = "und noch ein ganz anderer text der mit dem ersten gar nichts gemein hat heute"
    odd = [(None, text, None, None, None), (-1, None, "en", "s", 1), (-2, "", "en", "s", 1), (-3, "12 34 !?", "en", "s", 1)]
    odd += [(-4, other, "de", None, 1), (-4, other, "de", None, 1), (-4, text + " later", None, "s", 1), (-5, "long words here " * 9_000, "en", "s", 1)]
    frame = given.unionByName(spark.createDataFrame(odd, given.schema)).selectExpr("*", "7 AS piece", "'x' AS component", "1 AS spans")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in found}
    assert not {-1, -2, -3} & ids and {None, -4, -5} <= ids
    # The row without an id stays beside the one it is a near copy of; of the repeated rows one does.
    assert sum(r.doc_id == -4 for r in found) == 2 and sum(r.doc_id is None for r in found) == 1
    assert sum(r.doc_id == -5 for r in found) > 1
    places = {}
    for r in found:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:i]) for i in range(len(parts))]


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_the_rest_works_without_these_operators(tmp_path):
    """The folders and the pipeline may be deleted: the entry still imports and lists the other queries."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), [n for n in e.queries() if n.startswith(('op', 'pipeline'))], len(e.oracle_sql()))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert " [] " in done.stdout
