import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import parse, scalars

LISTS = [
    ("['A', 'B']", "A", 2),
    ('["A"]', "A", 1),
    ("[]", None, 0),
    (None, None, 0),
    ("", None, 0),
    ("oops", None, 0),
    ("['A', None]", "A", 2),
    ("[None, 'A']", None, 2),
    ("['a',]", "a", 1),
    ("('A','B')", None, 0),
    ('{"k":1}', None, 0),
    (" [' A '] ", "A", 1),
    ("['None of it', 'B']", "None of it", 2),
    ("['B', 'say None', None]", "B", 3),
    ("['a, b', 'c']", "a, b", 2),
    ("['it\\'s', 'x']", "it's", 2),
    ("[\"it's None\", None,]", "it's None", 2),
    ("['a'] x", None, 0),
    ("[VIDEO, AUDIO]", None, 0),
    ("[1, 2]", "1", 2),
    ("['a'\n, 'b']", "a", 2),
    ("[True, 'x']", "true", 2),
    ("['a' 'b']x", None, 0),
    ("[['a'], 'b']", '["a"]', 2),
    ("['\\ta ', 'b']", "a", 2),
    ("['a', 'b'", None, 0),
    ("['a',, 'b']", None, 0),
    ("[,]", None, 0),
    ("[1.5, -2]", "1.5", 2),
    ("['', 'b']", "", 2),
    ("['None']", "None", 1),
]


@pytest.mark.parametrize("text, first, count", LISTS)
def test_list_strings(spark, text, first, count):
    row = spark.createDataFrame([(text,)], "s string").select(
        parse.list_first("s").alias("f"), parse.list_count("s").alias("n")
    ).first()
    assert (row["f"], row["n"]) == (first, count)


def test_long_list_is_parsed_whole(spark):
    text = "[" + ", ".join(f"'item {i}'" for i in range(30_000)) + ", None]"
    assert spark.createDataFrame([(text,)], "s string").select(parse.list_count("s")).first()[0] == 30_001


def test_dates(spark):
    rows = [("bad",), ("2024-02-03",), ("2024-02-03 04:05:06",), (None,), ("2024-13-01",)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(parse.lenient_timestamp("s")).collect()]
    assert got == [None, dt.datetime(2024, 2, 3), dt.datetime(2024, 2, 3, 4, 5, 6), None, None]


@pytest.mark.parametrize(
    "later, earlier, days",
    [
        ("2024-01-01 00:00:00", "2024-01-01 01:00:00", -1),
        ("2024-01-02 00:00:00", "2024-01-01 00:00:00", 1),
        ("2024-01-02 00:00:00", "2024-01-01 00:00:01", 0),
        ("2024-01-01 00:00:00", "2024-01-02 00:00:00", -1),
        (None, "2024-01-02 00:00:00", None),
    ],
)
def test_lag_rounds_down(spark, later, earlier, days):
    df = spark.createDataFrame([(later, earlier)], "a string, b string")
    cols = [parse.lenient_timestamp(c) for c in ("a", "b")]
    assert df.select(scalars.lag_days(*cols)).first()[0] == days


def test_text_length_counts_code_points(spark):
    df = spark.createDataFrame([("naïve😀",), (None,), ("",)], "s string")
    assert [r[0] for r in df.select(scalars.text_length("s")).collect()] == [6, 0, 0]


def test_probability_names_are_distinct():
    long = "x" * 24
    assert scalars.probability_names(["A", long + "1", long + "2", long + "3"]) == [
        "prob_A", f"prob_{long}", f"prob_{long}_0000", f"prob_{long}_0001"
    ]


def test_prefix_is_removed_wherever_it_stands(spark):
    df = spark.createDataFrame([("P_aP_b",), (None,)], "s string")
    assert [r[0] for r in df.select(scalars.strip_prefix("s", "P_")).collect()] == ["ab", None]


def test_best_of_takes_the_first_of_equals(spark):
    df = spark.sql("select array(0.4D, 0.4D, 0.2D) as p")
    label, top = scalars.best_of(F.col("p"), F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    assert tuple(df.select(label, top).first()) == ("a", 0.4)


def test_row_key_is_stable_and_depends_on_content(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(scalars.row_key(None, [F.col("x"), F.col("y")])).collect()]
    assert len(set(keys)) == 3
    assert keys == [r[0] for r in df.repartition(3).orderBy(F.expr("y is not null"), "y").select(
        scalars.row_key(None, [F.col("x"), F.col("y")])).collect()]
