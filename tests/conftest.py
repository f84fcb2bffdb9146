import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quillspark.session import ready, session

    s = ready(session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"}))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
