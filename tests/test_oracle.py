"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as E
import check


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", list(E.queries()))
def test_query(spark, con, sf_dir, name):
    assert check.compare(spark, con, sf_dir, name, E.queries()[name], E.oracle_sql().get(name)) == ""


def test_entry(spark):
    assert E.entry(spark).columns == ["qid", "id", "dist", "rank"]


def test_oracles_belong_to_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
