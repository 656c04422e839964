import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from rivulet.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "rivulet-tests",
        master="local[4]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.sql.ansi.enabled": "true"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
