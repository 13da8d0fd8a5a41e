import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from fraudlens.session import get_session

    s = get_session("local[*]", app_name="fraudlens-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # a fresh folder per test; never cleaned by rm
    return tempfile.mkdtemp(prefix="fraudlens-test-")


@pytest.fixture(scope="session")
def tables(spark):
    from fraudlens.sources.tables import load_tables

    return load_tables(spark, SF_SMALL)
