import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from logtide.session import local_session
    session = local_session(cores=4, shuffle_partitions=4, app="logtide-tests")
    yield session


@pytest.fixture
def scratch(spark):
    from logtide.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make
