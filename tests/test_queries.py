"""Every registered query on the smallest tables, against its SQL oracle where it has one."""
from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import database, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# nothing need be found: the step list may be empty
MAY_BE_EMPTY = {"forward_selection"}


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, db, ORACLES[name]) is None
    else:
        assert df.count() > 0 or name in MAY_BE_EMPTY


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_is_the_flagship(spark):
    assert entry.entry(spark).columns == [
        "season", "team", "games", "wins", "losses", "ties", "points_for", "points_against", "differential", "place"]
