"""Every registered query against its SQL twin, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tripwright.plans.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr
    )


def test_every_query_has_a_twin():
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, duck, sf_dir, name):
    ours = entry.queries()[name](spark, sf_dir)
    theirs = duck.sql(entry.oracle_sql()[name])
    expected = _sorted(theirs.columns, theirs.fetchall())
    assert _sorted(ours.columns, ours.collect()) == expected
    types = dict(ours.dtypes)
    for column, dtype in zip(theirs.columns, map(str, theirs.types)):
        assert types[column] == TYPES.get(dtype, types[column])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
