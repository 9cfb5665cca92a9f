"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entries
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


# The queries over training data are tested beside their subpackage.
NAMES = sorted(name for module in entries.BASE for name in module.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem, _, checked = compare(spark, con, name, FOLDER)
    assert problem is None
    assert checked, "every registered query has SQL"


def test_entry_has_rows(spark):
    assert entries.entry(spark).count() > 0
