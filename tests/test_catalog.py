"""Queries of the catalog against DuckDB, and the driver contract."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from seekloom.catalog import ORACLES, QUERIES

SLOW = {"multi_hop_crawl", "stream_ingest", "stream_one_page_per_link", "index_in_two_steps"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_sql(spark, folder, database, name):
    frame = QUERIES[name](spark, folder)
    relation = database.execute(ORACLES[name])
    columns = [d[0] for d in relation.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, relation.fetchall())


def test_contract(spark):
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns
