import pytest
from pyspark.sql import types as T

from tidemark.llm.workers import importable

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return importable(spark)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Rows that break careless code: nulls, empty and repeated texts, unusual spaces, one long text, clashing names."""
    sentence = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "
    rows = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (4, "one"), (None, "one"), (None, None),
        (5, sentence * 30), (5, sentence * 30), (6, "x" * 900), (7, "né ü 日本 😀   word " * 40), (8, sentence * 3),
        (9, sentence * 3 + "end"), (10, "a\nb\na\n\nb\n" * 20), (11, "token = abcdef1234 AKIA" + "Z" * 16), (12, "ab" * 300 + "c"),
    ]
    extra = [(k, t, None, "s", 0, 1.5, "row", ["x"]) for k, t in rows]
    schema = T._parse_datatype_string(f"{COLUMNS}, score double, _row string, words array<string>")
    return spark.createDataFrame(extra, schema)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
