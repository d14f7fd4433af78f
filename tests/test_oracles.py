"""Every named query against its SQL twin, and shape checks for the ones without."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SF
from grainfold.plans import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (bool, int, float)) or hasattr(value, "as_integer_ratio"):
        return (1, float(value) + 0.0)
    if isinstance(value, datetime.datetime):
        return (2, value.isoformat())
    return (3, str(value))


def _sorted_rows(names, tuples):
    at = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(_plain(t[i]) for i in at) for t in tuples)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(found.columns) == sorted(names)
    assert _sorted_rows(found.columns, [tuple(r) for r in found.collect()]) == _sorted_rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.count() > 0
    assert len(set(found.columns)) == len(found.columns)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 180
