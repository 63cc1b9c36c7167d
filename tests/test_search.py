import math

import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tidemark.operators import models, search, select, stages, tfidf


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"c{i % 3}", i % 2, float(i % 3)) for i in range(120)]
    return spark.createDataFrame(data, "k long, actual string, fold int, x double").persist()


def make_counting(calls, stop_after=None):
    """A model that is right for the share of rows its parameter says."""

    def make(train, params):
        calls.append((params["q"], train.count()))
        if stop_after is not None and len(calls) > stop_after:
            raise RuntimeError("killed")
        right = F.pmod(F.hash("k"), F.lit(1000)) < int(1000 * params["q"])
        return lambda held: held.withColumn("predicted", F.when(right, F.col("actual")).otherwise(F.lit("c0")))

    return make


CANDIDATES = [{"q": (i * 7 % 10) / 10} for i in range(10)]


def run(rows, make, log):
    return search.halving_search(rows, make, {}, "k", "actual", folds=2, factor=3, threads=1, candidates=CANDIDATES, log=log)


def test_a_search_goes_on_where_it_was_killed(rows, tmp_path):
    whole = []
    best, trials = run(rows, make_counting(whole), None)
    assert [sum(t.round == r for t in trials) for r in range(3)] == [10, 4, 2] and best == {"q": 0.9}
    assert len(whole) == 2 * 16
    log = str(tmp_path / "log")
    first, then = [], []
    with pytest.raises(RuntimeError):
        run(rows, make_counting(first, stop_after=23), log)  # in the second round
    again = run(rows, make_counting(then), log)
    assert len(first) >= 24 and len(then) == 32 - 23  # only fits that were cut off are done twice
    assert again == (best, trials)
    repeated = []
    assert run(rows, make_counting(repeated), log) == (best, trials) and repeated == []
    # Other candidates are another search, in the same folder.
    other = []
    search.halving_search(rows, make_counting(other), {}, "k", "actual", folds=2, threads=1, candidates=CANDIDATES[:2], log=log)
    assert len(other) == 4


def test_chi_square_of_presence(spark):
    data = [("red red apple", "a"), ("red plum", "a"), ("green pear", "b"), ("green apple", "b"), ("blue apple", "c"), (None, "c"), ("red herring", None)]
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(data)], "k long, t string, c string")
    vocabulary = tfidf.tfidf_fit(df, "k", "t", 50, min_df=1, ngrams=(1, 1))
    got = {r["term"]: r for r in select.chi_square(df, vocabulary, "t", "c", (1, 1)).collect()}
    known = [(set((t or "").split()), c) for t, c in data if c]

    def chi2(term):
        total, out = len(known), 0.0
        held = sum(term in t for t, _ in known)
        for c in "abc":
            size = sum(x == c for _, x in known)
            for there, all_there in ((True, held), (False, total - held)):
                expected = size * all_there / total
                out += (sum(x == c and (term in t) == there for t, x in known) - expected) ** 2 / expected if expected else 0.0
        return out

    for term in ("red", "green", "apple", "plum", "blue"):
        assert math.isclose(got[term]["chi2"], chi2(term), rel_tol=1e-12), term
    assert got["herring"]["chi2"] == 0.0 and got["red"]["degrees"] == 2
    best = select.best_terms(select.chi_square(df, vocabulary, "t", "c", (1, 1)), 2).orderBy("idx").collect()
    assert [(r["term"], r["idx"]) for r in best] == [("green", 0), ("red", 1)]
    every = spark.createDataFrame([(0, "same", "a"), (1, "same", "b")], "k long, t string, c string")
    same = select.chi_square(every, tfidf.tfidf_fit(every, "k", "t", 5, ngrams=(1, 1)), "t", "c", (1, 1))
    assert [r["chi2"] for r in same.collect()] == [0.0]


def test_two_stage_as_a_stage(spark, rows, tmp_path):
    data = models.encode_features(rows.withColumn("label", F.col("x").cast("int")), ["x"])
    stage = stages.TwoStage(numClasses=3, other=1, maxIter=2, maxDepth=2, predictionCol="p", rule="hard")
    fitted = Pipeline(stages=[stage]).fit(data)
    scored = fitted.transform(data)
    assert scored.where("p <> label").count() == 0 and "_gate" not in scored.columns
    assert stages.MacroF1Evaluator(predictionCol="p").evaluate(scored) == 1.0
    model = fitted.stages[0]
    model.save(f"{tmp_path}/m")
    again = stages.TwoStageModel.load(f"{tmp_path}/m")
    assert again.getOrDefault("rule") == "hard" and again.uid == model.uid
    assert again.transform(data).select("k", "p").collect() == scored.select("k", "p").collect()
    stage.save(f"{tmp_path}/s")
    assert stages.TwoStage.load(f"{tmp_path}/s").getOrDefault("other") == 1
