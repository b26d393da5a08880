from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lotwise.session import local_session

    session = local_session("*", shuffle_partitions=8, app="lotwise-tests")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lotwise-test-ckpt-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lotwise-test-")


@pytest.fixture(scope="session")
def log01(spark):
    """The sf0.01 derived event log, cached for the session."""
    from lotwise.sources.fixtures import event_log

    df = event_log(spark, SF01).cache()
    df.count()
    return df
