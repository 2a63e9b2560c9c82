"""Every registered query against its SQL on the smallest given tables."""

import pytest
from compare import differences, oracle
from conftest import DATA

from tellerflow.queries import load

QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con():
    return oracle(DATA)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "run_pipeline"])  # test_pipeline runs the pipeline
def test_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, DATA), con, ORACLES[name]) is None
