import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from attrition.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions="2")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
