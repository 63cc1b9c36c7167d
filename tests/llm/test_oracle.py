import pytest

from checks.base import Entry
from tests.compare import connect, run
from tidemark.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", list(SQL))
def test_same_as_sql(spark, name):
    text, _ = run(spark, name, Entry(QUERIES[name], SQL[name], ()), "0.01", connect("0.01"))
    assert text == "ok"
