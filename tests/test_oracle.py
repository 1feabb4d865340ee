"""Every query against the same question in SQL, over the same tables."""

from pathlib import Path

import duckdb
import pytest

from votestream.plans import ORACLE_SQL, QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, name):
    with duckdb.connect() as db:
        for table in Path(sf_dir).glob("*.parquet"):
            db.sql(f"create view {table.stem} as select * from '{table}'")
        expected = db.sql(ORACLE_SQL[name])
        wanted = _rows(expected.columns, expected.fetchall())
        types = dict(zip(expected.columns, map(str, expected.types)))
    answer = QUERIES[name](spark, sf_dir)
    assert {column: TYPES[kind] for column, kind in answer.dtypes} == types
    assert _rows(answer.columns, answer.collect()) == wanted


@pytest.mark.parametrize("sf, flushes, full", [("sf0.001", 626, 93), ("sf0.01", 4269, 2230)])
def test_known_numbers_of_flushes(spark, sf, flushes, full):
    partials = QUERIES["partials"](spark, f"/root/testdata/{sf}")
    assert (partials.count(), partials.where("full").count()) == (flushes, full)


def test_entry_and_driver_contract(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 50
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())
