"""Every registered query against its SQL, value for value."""

import datetime

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.oracles import ORACLES
from checks.queries import QUERIES

NAMES = sorted(oracle_sql())


def plain(value):
    return (value is None, str(value) if isinstance(value, (str, datetime.date)) else value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    cursor = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = rows_of(columns, cursor.fetchall())
    actual = rows_of(result.columns, [tuple(r) for r in result.collect()])
    assert len(actual) == len(expected) > 0
    assert actual == expected


def test_each_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
