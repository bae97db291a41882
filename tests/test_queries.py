"""Every registered query against its SQL form on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from glossaflow.plans import catalog, oracle

TABLES = ("documents", "conversations", "benchmark", "labels")


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    """Queries of the optional training-data operators may have none; their own tests compare with brute force."""
    assert set(catalog.QUERIES) == set(oracle.statements())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, database, name):
    result = entry_points.queries()[name](spark, sf_dir)
    want = database.execute(entry_points.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(result.columns) == sorted(columns)
    got = normalised([tuple(r) for r in result.collect()], result.columns)
    assert got == normalised(want.fetchall(), columns)
    assert got


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
