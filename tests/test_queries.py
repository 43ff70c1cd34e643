"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_check import compare, duck
from shelfwatch.plans.oracle import ORACLE
from shelfwatch.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duck(FOLDER)


def test_every_sql_has_its_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    problem, _ = compare(spark, con, name, queries()[name], oracle_sql()[name], FOLDER)
    assert problem is None
