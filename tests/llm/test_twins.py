"""Queries of the corpus operators against SQL on another engine."""

import os

import duckdb
import pytest

from plateflow.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def other_engine(sf_dir):
    connection = duckdb.connect()
    for name in os.listdir(sf_dir):
        connection.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(str(row[k]) for k in order) for row in values)


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_same_rows(spark, other_engine, sf_dir, name):
    ours, theirs = QUERIES[name](spark, sf_dir), other_engine.sql(ORACLE_SQL[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours.columns, ours.collect()) == rows(theirs.columns, theirs.fetchall())


def test_one_query_per_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
