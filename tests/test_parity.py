"""Every registered query against its SQL twin on another engine."""

import os

import duckdb
import pytest

import __spark_entry__ as registry

CORPUS_QUERIES = registry.llm_queries.QUERIES if registry.llm_queries else {}
QUERIES = {
    name: query
    for name, query in registry.queries().items()
    if name != "pipeline" and name not in CORPUS_QUERIES
}
STATEMENTS = {name: sql for name, sql in registry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(tuple(str(row[index]) for index in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, other_engine, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir)
    theirs = other_engine.sql(STATEMENTS[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert sorted_rows(ours.columns, ours.collect()) == sorted_rows(
        theirs.columns, theirs.fetchall()
    )


def test_flagship_query(spark):
    assert registry.entry(spark).count() == 20
