"""Every registered query against the same result computed by DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from starmart.catalog import queries as catalog

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
                 "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "decimal(3,1)": "DECIMAL(3,1)"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    result = entry.queries()[name](spark, sf_dir)
    expected = duck.execute(entry.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {c: SPARK_TO_DUCK[t] for c, t in result.dtypes} == {
        c: ("BIGINT" if t == "HUGEINT" else t) for c, t in types.items()
    }
    theirs = canonical(list(types), expected.fetchall())
    ours = canonical(result.columns, [tuple(row) for row in result.collect()])
    assert len(ours) == len(theirs) > 0
    assert ours == theirs


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
