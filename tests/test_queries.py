"""Every driver query against its SQL counterpart, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from rollcall.plans.catalogue import QUERIES
from rollcall.plans.oracles import ORACLES

NAMES = ("region", "nation", "customer", "supplier", "orders", "events")


@pytest.fixture(scope="module")
def oracle(tables):
    connection = duckdb.connect()
    for name in NAMES:
        connection.execute(f"create view {name} as select * from '{tables}/{name}.parquet'")
    return connection


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, tables, name):
    result = QUERIES[name](spark, tables)
    cursor = oracle.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(names)
    assert _sorted(result.collect(), result.columns) == _sorted(cursor.fetchall(), names)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    totals = entry_module.entry(spark).collect()
    assert {row.dim for row in totals} == {"country", "gender", "registration_year"}


def test_years_ascend_with_null_last(spark, tables):
    years = [row.registration_year for row in QUERIES["count_by_year"](spark, tables).collect()]
    assert years[-1] is None
    assert years[:-1] == sorted(years[:-1])
