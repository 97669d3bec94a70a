import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lithosense.session import build_session

    tmp = tmp_path_factory.mktemp("spark")
    s = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.checkpoint.dir": str(tmp / "checkpoints"),
            "spark.sql.warehouse.dir": str(tmp / "warehouse"), "spark.sql.autoBroadcastJoinThreshold": "10m",
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf):
    from tests.oracle_check import connect

    return connect(sf)
