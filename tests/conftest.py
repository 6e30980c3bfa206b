import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # the plans that tests read should show the whole list of pushed filters
    session = build_session("tests", master="local[8]", shuffle_partitions=8,
                            settings={"spark.sql.maxMetadataStringLength": "2000"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
