"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from cyclelens.fixtures import TABLES

OTHERS = entry_module._LLM.queries() if entry_module._LLM else {}
QUERIES = {n: q for n, q in entry_module.queries().items() if n not in OTHERS}
ORACLE = entry_module.oracle_sql()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def by_name(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(v[i] for i in order) for v in values), key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLE)
    assert len(QUERIES) == 84


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(name, spark, sf_dir, duck):
    ours = QUERIES[name](spark, sf_dir)
    theirs = duck.sql(ORACLE[name])
    assert by_name(ours.columns, [tuple(r) for r in ours.collect()]) == by_name(
        theirs.columns, theirs.fetchall()
    )
    assert {c: TYPES[t] for c, t in ours.dtypes} == dict(
        zip(theirs.columns, [str(t) for t in theirs.types])
    )


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["date", "province", "city", "hour", "sum"]
