"""Every registered query against its DuckDB statement."""

import math

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("orders", "customer", "documents"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TABLES}/{table}.parquet'")
    yield connection
    connection.close()


def comparable(rows):
    def cell(value):
        if isinstance(value, float):
            return f"{value:.9f}" if math.isfinite(value) else str(value)
        return str(value)

    return sorted(tuple(map(cell, row)) for row in rows)


LEAD_QUERIES = sorted(set(registry.queries()) - set(registry.LLM_QUERIES))


def test_every_query_has_an_oracle():
    assert set(LEAD_QUERIES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", LEAD_QUERIES)
def test_query_agrees_with_duckdb(spark, duck, name):
    frame = registry.queries()[name](spark, TABLES)
    oracle = duck.sql(registry.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(oracle.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {listed} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert comparable(frame.select(*columns).collect()) == comparable(expected)
    assert expected


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.count() == 150
