import pytest

import __spark_entry__ as entries
from oracle_check import compare, connect
from tradewind.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    problem, rows, checked = compare(spark, connect(FOLDER), name, FOLDER)
    assert problem is None and checked and rows


def test_every_operator_is_registered():
    names = [n for n in entries.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entries.queries()
