import os

import pytest

from muara.session import local_session, scratch_path
from muara.sources.snapshots import Warehouse

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="muara-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "test"))


@pytest.fixture(scope="session")
def folder():
    return FOLDER
