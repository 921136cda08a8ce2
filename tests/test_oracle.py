"""Every registered question against its DuckDB statement, values and names."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from tests.conftest import SF

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Pairs of everything with everything, and Python per row or column.
NEVER_PLANNED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
)
# The operators for training text have tests of their own.
QUESTIONS = {n: q for n, q in entry_point.queries().items() if not n.startswith(("op", "pipeline"))}
ORACLE = {n: s for n, s in entry_point.oracle_sql().items() if not n.startswith(("op", "pipeline"))}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_question():
    assert set(ORACLE) <= set(QUESTIONS)


def test_only_eigenvalues_and_estimates_go_without_oracle():
    assert set(QUESTIONS) - set(ORACLE) == {"v4_principal_components", "q36_arpu_approx"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, name):
    found = QUESTIONS[name](spark, SF)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(found.columns) == sorted(columns)
    order = sorted(columns)
    expected = [tuple(r[columns.index(c)] for c in order) for r in result.fetchall()]
    actual = [tuple(r[c] for c in order) for r in found.collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in NEVER_PLANNED if word in plan]


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
