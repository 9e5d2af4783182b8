"""Every query against its DuckDB SQL on the smallest tables."""

import duckdb
import pytest
from conftest import DATA

import __spark_entry__ as entry

SF = f"{DATA}/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr([row[i] for i in order]) for row in rows)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert canonical(df.collect(), df.columns) == canonical(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_runs_without_sql(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 4
