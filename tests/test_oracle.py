"""Every query gives the rows of its SQL."""

import pytest
from compare import connect, differences
from conftest import FOLDER

import __spark_entry__ as entry_module
from cohortloom.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    assert differences(df, duck, entry_module.oracle_sql()[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
