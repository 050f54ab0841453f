"""Shared fixtures: one local session for the whole run (JVM start is slow)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session
    return local_session("*", shuffle_partitions=8, app_name="tillroll-tests")


@pytest.fixture(scope="session")
def smoke_dir():
    if not os.path.isdir(SMOKE_DIR):
        pytest.skip("driver test data not present")
    return SMOKE_DIR
