"""Every registered query with a SQL counterpart gives the same rows in both engines."""

import os

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry_module

ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in sorted(os.listdir(SF)):
        connection.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{table}'")
    return connection


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(0.0 if isinstance(r[i], float) and r[i] == 0 else r[i] for i in order)) for r in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.dtypes) == sorted((d[0], TYPES.get(str(d[1]), str(d[1]))) for d in result.description)
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == normal(columns, result.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).first()["total_records"] == 1000
