from __future__ import annotations

import pytest

from tests.oracle import session


@pytest.fixture(scope="session")
def spark():
    return session("strata-tests")


@pytest.fixture
def rows(spark):
    """``rows("a int, b string", [(1, "x")])`` as a frame."""
    return lambda schema, data: spark.createDataFrame(data, schema)
