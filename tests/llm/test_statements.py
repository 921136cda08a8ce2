import duckdb
import pytest

from mercato.llm.queries import QUERIES
from mercato.llm.statements import SQL
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [c[0] for c in result.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    actual = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)
    assert actual == sorted(result.fetchall(), key=repr)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
