"""Every registered query against its SQL."""

import pytest

from checks import REGISTRY
from tests.compare import connect, run


@pytest.fixture(scope="module")
def con():
    return connect("0.001")


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    text, _ = run(spark, name, REGISTRY[name], "0.001", con)
    assert text == "ok" or text.startswith("rows ")
