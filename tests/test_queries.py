import os

import pytest

import __spark_entry__ as contract
from check import connect, differences

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="shared tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert differences(contract.queries()[name](spark, TABLES), duck, contract.oracle_sql()[name]) == []


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    own = set(contract.QUERIES)
    assert own - set(contract.oracle_sql()) == {"train_logistic", "predict_batch", "score_and_evaluate"}


def test_entry(spark):
    assert contract.entry(spark).count() > 0
