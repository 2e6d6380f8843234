"""Every registered query against its SQL twin, and the driver contract."""

import pytest

import __spark_entry__ as entry
from skylag.plans import catalog
from tools.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_its_twin(spark, con, name):
    assert compare(spark, con, SF, name, entry.oracle_sql().get(name)) == []


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).take(1)) == 1
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert {n for n in catalog.QUERIES if n not in catalog.SQL} == {
        "regression_train_score",
    }
