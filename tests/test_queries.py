"""Every registered query against its SQL on the smallest given tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import check, open_duckdb

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are absent")


@pytest.fixture(scope="module")
def con():
    return open_duckdb(FOLDER)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert {r.split for r in entry(spark).collect()} == {"train", "test"}


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    assert check(spark, con, FOLDER, name) == ""
