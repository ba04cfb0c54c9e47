import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from recordferry.session import local_session  # noqa: E402
from recordferry.sources.bindings import Bindings  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return Bindings(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def bindings(spark):
    return Bindings(spark, "/root/testdata/sf0.01")


@pytest.fixture
def rows(spark):
    """Frame from a schema text and tuples; inputs of unit tests are this small."""
    def make(schema: str, *data):
        return spark.createDataFrame(list(data), schema)
    return make
