"""Every query against its SQL counterpart on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallybrook.plans.oracle import ORACLE_SQL
from tallybrook.plans.queries import REGISTRY

QUERIES = dict(REGISTRY)
ORACLE = dict(ORACLE_SQL)
TABLES = ("events", "lineitem", "part")

# DuckDB type of each Spark type a result may have.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.keys() <= entry_module.queries().keys()
    assert ORACLE.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    expected_names = [column[0] for column in cursor.description]
    expected_types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()

    assert sorted(result.columns) == sorted(expected_names)
    for column, dtype in result.dtypes:
        assert SAME_TYPE[dtype] == expected_types[column], column
    assert expected, "an empty result proves nothing"
    assert _bag(result.columns, result.collect()) == _bag(expected_names, expected)


def test_entry_is_the_flagship(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["price_tier", "orders", "revenue"]
    assert {row.price_tier for row in result.collect()} == {"budget", "mid", "premium"}
