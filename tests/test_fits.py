"""How often and how widely the plans of a fit and of scoring go over their rows."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks.base import statements
from tidemark.operators import models, tfidf
from tidemark.operators.rolling import _within_reach, rolling
from tidemark.plans import features as fe, scoring, training


def windows(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(line.lstrip(" :+-").startswith("Window [") for line in plan.splitlines())


def test_sums_before_a_row_and_over_the_group_share_a_window(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    assert windows(rolling(events, "user_id", "ts", "event_id", F.col("event_type") == "click", "event_type")) == 2


def test_packed_rows_give_the_same_statistics(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    # Some rows twice, some without a key, a group or a time.
    rows = events.union(events.where("event_id % 50 = 0")).withColumns({
        "event_id": F.when(F.col("event_id") % 31 != 0, F.col("event_id")),
        "user_id": F.when(F.col("user_id") % 29 != 0, F.col("user_id") % 5),
        "ts": F.when(F.col("value") > 5, F.col("ts")),
    })
    args = ("user_id", "ts", "event_id", F.col("event_type") == "click", "event_type")
    for options in ({}, {"history": rows.where("event_id % 3 = 0")}, {"max_rows": 40}):
        batch = rows.where("event_id % 2 = 0 or event_id is null") if "history" in options else rows
        want, got = rolling(batch, *args, **options), rolling(batch, *args, packed=True, **options)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_history_within_reach_is_swept(spark):
    rows = spark.sql("select id as k, 'p' as p, timestamp_seconds(id * 600) as ts, 1 as a, 'x' as kind from range(1000)")
    batch = rows.where("k between 500 and 510")
    out = rolling(batch, "p", "ts", "k", "a", "kind", history=rows)
    got = {r["k"]: r["platform_volume_3h"] for r in out.collect()}
    assert got == {k: 18 for k in range(500, 511)}  # those exactly three hours old are in
    assert _within_reach(rows, batch, "ts", 3 * 3600 * 10**6).agg(F.min("k"), F.max("k")).first() == (482, 510)


@pytest.mark.parametrize("most, want", [(10, 1), (10**6, models.FITS)])
def test_fits_of_many_rows_go_one_by_one(spark, monkeypatch, most, want):
    seen = []

    class Pool(ThreadPoolExecutor):
        def __init__(self, n):
            seen.append(n)
            super().__init__(n)

    monkeypatch.setattr(models, "ThreadPoolExecutor", Pool)
    monkeypatch.setattr(models, "SIDE_BY_SIDE", most)
    train = spark.createDataFrame([(i % 3, Vectors.dense([float(i % 3), 1.0])) for i in range(30)], ["label", "features"])
    model = models.fit_two_stage(train, 4, 0, maxIter=1, maxDepth=1)
    assert seen == [want]
    # Class 3 never occurs and gets 0.
    out = models.predict(train, model, list("abcd")).collect()
    assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 and r["probabilities"][3] == 0 for r in out)


@pytest.mark.filterwarnings("ignore")
def test_repeated_keys_are_looked_for_once(spark, sf, monkeypatch):
    calls, found = [], tfidf.shared_keys

    def counting(df, key):
        calls.append(df.columns)
        return found(df, key)

    monkeypatch.setattr(tfidf, "shared_keys", counting)
    raw = statements(spark, sf)
    rows, rates = fe.training_rows(raw, fe.Spec(rare_rows=2))
    bundle = training.fit(rows.where("not is_test"), rates, "logistic", tier=2, params={"max_iter": 2}, text_terms=(20, 20, 20))
    assert len(calls) == 1
    twice = raw.limit(50).union(raw.limit(5))
    out = scoring.score(twice, bundle, cold=True)
    assert len(calls) == 2 and calls[1] == raw.columns
    assert out.count() == 55 and out.where("predicted = 'ERROR'").isEmpty()
