"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import SMALL

import __spark_entry__ as driver

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
# The corpus operators have tests of their own.
CATALOG = [n for n, f in driver.queries().items() if f.__module__.startswith("catalog.")]
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.fixture(scope="module")
def results(spark):
    """All queries, a few at a time: most of their time at this scale is waiting between stages."""

    def run(name):
        try:
            frame = driver.queries()[name](spark, SMALL)
            return frame.columns, frame.collect()
        except Exception as error:  # reported by the test of that query
            return error

    names = sorted(CATALOG)
    with ThreadPoolExecutor(6) as pool:
        return dict(zip(names, pool.map(run, names), strict=True))


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else round(value, 6) + 0.0
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def test_every_query_has_a_counterpart():
    assert set(CATALOG) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_matches_sql(results, engine, name):
    if isinstance(results[name], Exception):
        raise results[name]
    columns, rows = results[name]
    relation = engine.sql(driver.oracle_sql()[name])
    assert sorted(columns) == sorted(relation.columns)
    assert table(columns, rows) == table(relation.columns, relation.fetchall())


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 7
