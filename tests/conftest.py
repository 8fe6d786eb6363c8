import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from civicflow.session import build_session
    s = build_session("local[4]", app="civicflow-tests", shuffle_partitions=8,
                      extra={"spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import oracle_compare
    return oracle_compare.duck(SF_SMALL)
