import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tellerflow.session import local_session

    session = local_session("tellerflow-tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from tellerflow.lake import lake_for

    return lake_for(spark, DATA)
