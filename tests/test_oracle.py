"""Every registered query against its SQL twin."""

import re

import pytest

import __spark_entry__ as entry
from compare import connect, difference, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, con, name):
    ours = spark_rows(entry.queries()[name](spark, SF_DIR))
    assert difference(ours, duck_rows(con, entry.oracle_sql()[name])) is None


def of_the_library(name):
    """Corpus queries have tests of their own."""
    return name != "pipeline" and not re.match(r"op\d+_", name)


@pytest.mark.parametrize("name", sorted(filter(of_the_library, set(entry.queries()) - set(entry.oracle_sql()))))
def test_runs_without_sql(spark, con, name):
    orders = con.execute("SELECT count(*) FROM orders").fetchall()[0][0]
    assert entry.queries()[name](spark, SF_DIR).count() == orders


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
