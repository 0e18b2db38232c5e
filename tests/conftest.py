import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from stratiform.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("stratiform-tests", 4)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
