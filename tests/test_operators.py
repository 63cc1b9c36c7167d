import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode, evaluate as ev, labels, models, quality, sampling, search, skew, split, tfidf


def classes(spark, sizes):
    rows = [(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "k long, c string")


def test_rare_means_up_to_twenty(spark):
    df = classes(spark, {"a": 19, "b": 20, "d": 21})
    assert {r["c"] for r in quality.drop_rare(df, "c").collect()} == {"d"}
    assert {r["c"] for r in quality.rare_classes(df, "c").collect()} == {"a", "b"}


def test_sparse_classes_leave_both_splits(spark):
    rows = [("a", False), ("a", False), ("b", False), ("b", True), ("t", True), ("a", True)]
    df = spark.createDataFrame(rows, "c string, test boolean")
    assert {r["c"] for r in quality.drop_sparse(df, "c", "test").collect()} == {"a"}
    assert [r["c"] for r in quality.only_test_classes(df, "c", "test").collect()] == ["t"]
    assert [r["c"] for r in quality.singleton_classes(df, "c", "test").collect()] == ["b"]


def test_fill_guard(spark):
    df = spark.createDataFrame([("x", None), ("", "y")], "a string, b string")
    quality.require_fill(df, ["a", "b"], 0.5)
    with pytest.raises(ValueError, match="filled below"):
        quality.require_fill(df, ["a", "b"], 0.6)


def test_absent_columns_warn_and_get_sentinels(spark):
    df = spark.createDataFrame([(1,)], "k long")
    with pytest.warns(UserWarning):
        row = quality.add_missing(df, ["t"], ["n"]).first()
    assert row["t"] == "__MISSING__" and row["n"] == -1


def test_numbers_from_text(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "n string")
    assert [r[0] for r in df.select(quality.impute_number("n")).collect()] == [7, -1, -1]


@pytest.mark.parametrize(
    "total, target, fraction, step, stride",
    [(100, 40, 0.4, 3, 2), (100, 60, 0.6, 1, 2), (100, 100, 1.0, 1, 1), (100, 500, 1.0, 1, 1), (0, 5, 1.0, 1, 1),
     (1000, 3, 0.003, 334, 333), (100, 50, 0.5, 2, 2)],
)
def test_rates(total, target, fraction, step, stride):
    rate = sampling.plan_rate(total, target)
    assert (rate.fraction, rate.step, rate.stride) == (pytest.approx(fraction), step, stride)


def test_hash_sample_is_repeatable_and_nested(spark):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    ids = lambda d: {r["k"] for r in d.collect()}
    small, large = (ids(sampling.hash_sample(df, "k", f)) for f in (0.3, 0.7))
    assert small < large
    assert ids(sampling.hash_sample(df.repartition(13), "k", 0.3)) == small
    assert abs(len(large) / 20_000 - 0.7) < 0.02


@pytest.mark.parametrize("max_rows", [1000, 10])
def test_stratified_sample_takes_exact_sizes(spark, max_rows):
    df = classes(spark, {"a": 500, "b": 30, "d": 3})
    got = sampling.stratified_sample(df, "c", 20, "k", max_rows=max_rows).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in got} == {"a": 20, "b": 20, "d": 3}


@pytest.mark.parametrize("max_rows", [10_000, 50])
def test_running_sums_across_cells(spark, max_rows):
    rng = random.Random(1)
    rows = [(i, "hot" if rng.random() < 0.8 else rng.choice("ab"), rng.randrange(20), rng.randrange(5)) for i in range(1500)]
    df = spark.createDataFrame(rows, "k long, g string, t int, v int")
    cells = skew.with_cells(df, ["g"], ["t", "k"], max_rows)
    got = skew.running_sums(cells, ["g"], ["t", "k"], {"s": F.col("v")}, {"all": F.col("v")}).collect()
    for r in got:
        mates = [x for x in rows if x[1] == r["g"]]
        assert r["s"] == sum(x[3] for x in mates if (x[2], x[0]) < (r["t"], r["k"]))
        assert r["all"] == sum(x[3] for x in mates)
    sizes = cells.groupBy("g", "_cell").count().agg(F.max("count"), F.max("_cell")).first()
    if max_rows == 50:
        assert sizes[0] < 300 and sizes[1] > 5


def test_cells_are_the_same_when_tasks_are_retried(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    cells = skew.with_cells(df, ["g"], ["k"], 100)
    first = {r["k"]: r["_cell"] for r in cells.collect()}
    assert first == {r["k"]: r["_cell"] for r in cells.repartition(5).collect()}
    assert [first[k] for k in sorted(first)] == sorted(first.values())


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_lookup_equals_plain_join(spark, how):
    df = spark.range(2000).select(F.col("id").alias("k"), F.expr("case when id % 3 = 0 then 'hot' else concat('v', id % 40) end").alias("g"))
    df = df.withColumn("g", F.expr("case when k % 101 = 0 then null else g end"))
    dim = df.where("g <> 'v7'").groupBy("g").agg(F.count("*").alias("n"))
    plain = sorted(map(str, df.join(dim, "g", how).collect()))
    assert sorted(map(str, skew.lookup(df, dim, "g", how, ["k"], limit=0, salts=5).select(*df.join(dim, "g", how).columns).collect())) == plain
    assert sorted(map(str, skew.lookup(df, dim, "g", how).select(*df.join(dim, "g", how).columns).collect())) == plain


def test_dimension_is_broadcast_only_when_small(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 5).alias("g"))
    dim = df.groupBy("g").agg(F.count("*").alias("n"))
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(skew.lookup(df, dim, "g"))
        assert "BroadcastHashJoin" not in plan(skew.lookup(df, dim, "g", limit=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("sortable", [1_000_000, 5])
@pytest.mark.parametrize("spread", [1, 3, 500_000, 86_400 * 400_000])
def test_chronological_split(spark, sortable, spread):
    rng = random.Random(spread)
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(4) * spread)) for i in range(97)]
    df = spark.createDataFrame(rows, "k long, ts timestamp")
    got = {r["k"]: r["is_test"] for r in split.chrono_split(df, "ts", "k", sortable=sortable).collect()}
    order = [k for k, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert [got[k] for k in order] == [False] * 77 + [True] * 20


def test_split_shuffles_no_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    plan = split.chrono_split(df, "ts", "event_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_folds_are_contiguous_and_even(spark):
    df = classes(spark, {"a": 23, "b": 7, "d": 2})
    got = split.stratified_folds(df, "c", ["k"], 5).collect()
    sizes = [sum(r["fold"] == i for r in got) for i in range(5)]
    assert max(sizes) - min(sizes) <= 1
    for c in "abd":
        run = [r["fold"] for r in sorted(got, key=lambda r: r["k"]) if r["c"] == c]
        assert run == sorted(run)
        counts = [run.count(i) for i in range(5)]
        assert max(counts) - min(counts) <= 1


def test_labels_are_sorted(spark):
    index = labels.label_index(classes(spark, {"b": 1, "B": 1, "a": 2}), "c")
    assert labels.label_list(index, "c") == ["B", "a", "b"]


# --- encoders --------------------------------------------------------------------------


def encode_rows(spark):
    rows = [(i, "x" if i % 2 else "y", int(i % 4 == 1), i % 5) for i in range(40)] + [(40, "one", 1, 0)]
    return spark.createDataFrame(rows, "k long, v string, c int, fold int")


def smooth(n, hits, prior):
    var = prior * (1 - prior)
    if not n:
        return prior
    p = hits / n
    den = n * var + p * (1 - p)
    return prior if den == 0 else n * var / den * p + (1 - n * var / den) * prior


def test_target_encoding_and_unseen(spark):
    df = encode_rows(spark)
    tables = encode.target_fit(df, ["v"], "c", 2, F.col("fold"))
    probe = spark.createDataFrame([(0, "x"), (1, "y"), (2, "one"), (3, "never"), (4, None)], "k long, v string")
    got = {r["k"]: r["v_te"] for r in encode.target_apply(probe, tables, ["v"]).collect()}
    prior = 11 / 41
    assert got[0][1] == pytest.approx(smooth(20, 10, prior))
    assert got[1][1] == pytest.approx(smooth(20, 0, prior))
    assert got[2][1] == pytest.approx(smooth(1, 1, prior))
    assert got[3] == got[4] == pytest.approx([1 - prior, prior])


def test_cross_fit_leaves_out_the_own_fold(spark):
    df = encode_rows(spark)
    tables = encode.target_fit(df, ["v"], "c", 2, F.col("fold"))
    rows = df.collect()
    for r in encode.target_cross_fit(df, tables, ["v"], F.col("fold")).collect():
        rest = [x for x in rows if x["fold"] != r["fold"]]
        mine = [x["c"] for x in rest if x["v"] == r["v"]]
        prior = sum(x["c"] for x in rest) / len(rest)
        assert r["v_te"][1] == pytest.approx(smooth(len(mine), sum(mine), prior))


def test_single_class_has_no_variance(spark):
    df = spark.createDataFrame([(1, "x", 0), (2, "y", 0)], "k long, v string, c int")
    tables = encode.target_fit(df, ["v"], "c", 1, F.lit(0))
    assert [r["v_te"] for r in encode.target_apply(df, tables, ["v"]).collect()] == [[1.0], [1.0]]


def test_ordinal_codes_and_unknown(spark):
    df = spark.createDataFrame([("b", "z"), ("a", "z")], "u string, w string")
    codes = encode.ordinal_fit(df, ["u", "w"])
    probe = spark.createDataFrame([("a", "z"), ("b", "q"), ("c", None)], "u string, w string")
    assert [tuple(r) for r in encode.ordinal_apply(probe, codes, ["u", "w"]).select("u", "w").collect()] == [
        (0, 0), (1, -1), (-1, -1)
    ]


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    assert [tuple(r) for r in encode.standardise(df, ["a", "b"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_tfidf_by_hand(spark):
    rows = [(1, "Über alles über"), (2, "über naïve 😀 naïve"), (3, ""), (4, "x"), (5, None), (6, "alles naïve")]
    df = spark.createDataFrame(rows, "k long, t string")
    vocabulary = {r["term"]: r for r in tfidf.tfidf_fit(df, "k", "t", 10).collect()}
    assert set(vocabulary) == {"über", "alles", "naïve"}  # each in two texts; no bigram is
    idf = math.log(7 / 3) + 1
    assert vocabulary["über"]["idf"] == pytest.approx(idf)
    got = {(r["k"], r["term"]): r["weight"] for r in tfidf.tfidf_apply(df, tfidf.tfidf_fit(df, "k", "t", 10), "k", "t").collect()}
    raw = {"über": (1 + math.log(2)) * idf, "alles": idf}
    norm = math.sqrt(sum(w * w for w in raw.values()))
    assert got[(1, "über")] == pytest.approx(raw["über"] / norm)
    assert {k for k, _ in got} == {1, 2, 6}
    vectors = tfidf.tfidf_vectors(df, tfidf.tfidf_fit(df, "k", "t", 10), "k", "t", "v").collect()
    assert len(vectors) == 6 and {r["k"]: r["v"].numNonzeros() for r in vectors} == {1: 2, 2: 2, 3: 0, 4: 0, 5: 0, 6: 2}


def test_tfidf_of_repeated_and_missing_keys(spark, monkeypatch):
    """Rows with one key (null is one too) count as one text; counts are exact however few buckets are counted first."""
    from collections import Counter

    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 12))) for i in range(40)]
    rows += [(3, "w1 w1 w2"), (3, None), (None, "w5 w6"), (None, "w5"), (77, "zz yy")]
    texts = {}
    for k, t in rows:
        words = (t or "").split()
        texts.setdefault(k, Counter()).update([w for w in words if len(w) > 1] + [f"{a} {b}" for a, b in zip(words, words[1:])])
    total, in_texts = sum(texts.values(), Counter()), Counter(t for c in texts.values() for t in c)
    often = sorted((t for t in total if in_texts[t] >= 2), key=lambda t: (-total[t], t))
    df = spark.createDataFrame(rows, "k long, t string").repartition(3)
    monkeypatch.setattr(tfidf, "SPARE", 1)
    for buckets, most in ((1 << 20, 9), (64, 9), (7, 3), (64, 1000)):
        monkeypatch.setattr(tfidf, "BUCKETS", buckets)
        vocabulary = tfidf.tfidf_fit(df, "k", "t", most)
        assert [tuple(r) for r in vocabulary.select("term", "df").orderBy("idx").collect()] == [(t, in_texts[t]) for t in sorted(often[:most])]
    idf = {r["term"]: r["idf"] for r in vocabulary.collect()}
    want = {}
    for k, counts in texts.items():
        w = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
        want |= {(k, t): x / math.sqrt(sum(y * y for y in w.values())) for t, x in w.items()}
    got = {(r["k"], r["term"]): r["weight"] for r in tfidf.tfidf_apply(df, vocabulary, "k", "t").collect()}
    assert got == pytest.approx(want)
    vectors = tfidf.tfidf_vectors(df, vocabulary, "k", "t", "v").select("k", "v").collect()
    place = {r["idx"]: r["term"] for r in vocabulary.collect()}
    assert len(vectors) == len(rows)
    for r in vectors:
        found = {place[int(i)]: x for i, x in zip(r["v"].indices, r["v"].values)}
        assert found == pytest.approx({t: x for (k, t), x in want.items() if k == r["k"] and k is not None})
    empty = vocabulary.where("false")
    assert tfidf.tfidf_apply(df, empty, "k", "t").count() == 0
    assert {r["v"].size for r in tfidf.tfidf_vectors(df, empty, "k", "t", "v").collect()} == {0}


def test_tfidf_leaves_texts_where_they_are(spark):
    df = spark.createDataFrame([(i, f"aa bb c{i}") for i in range(9)], "k long, t string").repartition(2)
    df = df.localCheckpoint()
    vocabulary = tfidf.tfidf_fit(df, "k", "t", 5)
    for out in (tfidf.tfidf_apply(df, vocabulary, "k", "t"), tfidf.tfidf_vectors(df, vocabulary, "k", "t", "v")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_rows_in_files_of_a_size(spark):
    """No task gets more than a file, and every fourth row of the files is every fourth of all."""
    ids = [None, None, *[i // 2 for i in range(100)]]
    df = spark.createDataFrame([(i,) for i in random.Random(3).sample(ids, len(ids))], "k long").repartition(5)
    dealt = sampling.in_files(df, "k", 8, max_rows=20)
    parts = [[r for r in p] for p in dealt.rdd.glom().collect()]
    files = {}
    for part in parts:
        for r in part:
            files.setdefault(r["file"], []).append(r["k"])
    assert [len(files[i]) for i in sorted(files)] == [8] * 12 + [6]
    assert [k for i in sorted(files) for k in files[i]] == ids
    assert all(len({id(p) for p in parts if any(r["file"] == i for r in p)}) == 1 for i in files)


def test_bigrams_and_trigrams(spark):
    df = spark.createDataFrame([("aa bb cc",), ("aa",), ("",)], "t string")
    got = [r[0] for r in df.select(tfidf.terms_of("t", (1, 3))).collect()]
    assert got == [["aa", "bb", "cc", "aa bb", "bb cc", "aa bb cc"], ["aa"], []]


# --- metrics ---------------------------------------------------------------------------


def test_metrics_leave_out_unknown_rows(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), (None, "a"), ("a", "ERROR"), ("c", "a")]
    pairs = ev.confusion(spark.createDataFrame(rows, "x string, y string"), "x", "y")
    counts = {r["class"]: (r["tp"], r["fp"], r["fn"]) for r in ev.ovr_counts(pairs).collect()}
    assert counts == {"a": (1, 1, 1), "b": (1, 1, 0), "c": (0, 0, 1)}
    macro = ev.macro_prf(ev.ovr_counts(pairs)).first()
    assert macro["macro_f1"] == pytest.approx((0.5 + 2 / 3 + 0) / 3)
    assert ev.balanced_accuracy(ev.ovr_counts(pairs)).first()[0] == pytest.approx((0.5 + 1 + 0) / 3)
    cells = ev.full_confusion(pairs).collect()
    assert len(cells) == 9 and sum(r["n"] for r in cells) == 4


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "x string, y string")
    assert tuple(ev.macro_prf(ev.ovr_counts(ev.confusion(empty, "x", "y"))).first()) == (0.0, 0.0, 0.0)
    assert tuple(ev.evaluate(empty, "x", "y").first()) == (0.0, 0.0) and ev.macro_f1(empty, "x", "y") == 0.0


def test_macro_f1_as_a_number(spark):
    rng = random.Random(4)
    rows = [(rng.choice("abc"), rng.choice(["a", "b", "d", "ERROR", None])) for _ in range(200)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert ev.macro_f1(df, "x", "y") == pytest.approx(ev.evaluate(df, "x", "y").first()["macro_f1"])


@pytest.mark.parametrize("max_rows", [10_000, 7])
def test_trajectory_against_a_loop(spark, max_rows):
    rng = random.Random(2)
    rows = [(i, rng.choice("abc"), rng.choice("abc")) for i in range(105)]
    df = spark.createDataFrame(rows, "k long, x string, y string")
    got = {r["rows_done"]: r["macro_f1"] for r in ev.trajectory(df, "x", "y", ["k"], 20, max_rows=max_rows).collect()}
    assert sorted(got) == [20, 40, 60, 80, 100]
    for n, f1 in got.items():
        part = spark.createDataFrame(rows[:n], "k long, x string, y string")
        assert f1 == pytest.approx(ev.evaluate(part, "x", "y").first()["macro_f1"])


# --- models ----------------------------------------------------------------------------


def test_hard_rule_and_argmax_differ(spark):
    df = spark.sql("select array(0.4D, 0.2D, 0.2D, 0.2D) as p")  # not-other 0.6, spread evenly
    names = ["other", "a", "b", "c"]
    assert df.select(models.argmax_label(F.col("p"), names)).first()[0] == "other"
    assert df.select(models.hard_label(F.col("p"), names, 0)).first()[0] == "a"


def test_stitched_probabilities_sum_to_one(spark):
    df = spark.sql("select 0.3D as o, array(0.5D, 0.25D, 0.25D) as r")
    for other in range(4):
        p = df.select(models.stitch(F.col("o"), F.col("r"), other)).first()[0]
        assert sum(p) == pytest.approx(1) and p[other] == 0.3 and len(p) == 4


def blobs(spark):
    rng = random.Random(0)
    rows = []
    for i in range(180):
        c = i % 3
        rows.append((i, c, "abc"[c], [float(c) + rng.gauss(0, 0.2), float(c == 1) + rng.gauss(0, 0.2)]))
    df = spark.createDataFrame(rows, "k long, label int, actual string, x array<double>")
    return models.encode_features(df, ["x"], sizes={"x": 2})


def test_two_stage_model_survives_a_round_trip(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = blobs(spark)
    model = models.fit_two_stage(df, 3, 1, maxIter=4, maxDepth=3)
    model.write().overwrite().save(f"{tmp_path}/m")
    out = models.predict(df, PipelineModel.load(f"{tmp_path}/m"), ["a", "b", "c"])
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    low, high, n = out.agg(F.min(total), F.max(total), F.min(F.size("probabilities"))).first()
    assert low == pytest.approx(1) and high == pytest.approx(1) and n == 3
    assert ev.evaluate(out, "actual", "predicted").first()["macro_f1"] > 0.9


def test_models_beat_the_majority(spark):
    df = blobs(spark)
    floor = df.withColumn("predicted", F.lit(models.most_frequent(df, "actual")))
    base = ev.evaluate(floor, "actual", "predicted").first()["macro_f1"]
    flat = models.predict(df, models.fit_flat_trees(df, 3, maxIter=3, maxDepth=2), ["a", "b", "c"])
    line = models.predict(df, models.fit_logistic(df, max_iter=20), ["a", "b", "c"])
    for out in (flat, line):
        assert ev.evaluate(out, "actual", "predicted").first()["macro_f1"] > base + 0.3


def test_class_weights_balance(spark):
    df = classes(spark, {"a": 30, "b": 10})
    got = {r["c"]: r["weight"] for r in models.class_weights(df, "c").collect()}
    assert got == {"a": pytest.approx(40 / 60), "b": pytest.approx(2.0)}


def test_halving_rounds_and_draws():
    assert search.rounds(50, 3) == [50, 17, 6, 2]
    space = {
        "n": {"type": "randint", "low": 5, "high": 8},
        "r": {"type": "loguniform", "low": 0.001, "high": 0.4},
        "s": {"type": "uniform", "low": 0.6, "high": 1.0},
    }
    draws = search.draw_all(space, 200, 1)
    assert draws == search.draw_all(space, 200, 1)
    assert {d["n"] for d in draws} == {5, 6, 7}
    assert all(0.001 <= d["r"] <= 0.4 and 0.6 <= d["s"] <= 1.0 for d in draws)
    with pytest.raises(ValueError):
        search.draw({"type": "normal", "low": 0, "high": 1}, None)


def test_halving_keeps_the_better_candidates(spark):
    df = classes(spark, {"a": 40, "b": 40}).withColumn("fold", (F.col("k") % 2).cast("int"))

    def make(train, params):
        return lambda rows: rows.withColumn(
            "predicted", F.when(F.col("k") % 10 < params["good"], F.col("c")).otherwise(F.lit("a"))
        )

    best, trials = search.halving_search(
        df, make, {}, "k", "c", folds=2, factor=2, candidates=[{"good": g} for g in (1, 9, 5, 3)]
    )
    assert best == {"good": 9}
    assert [sum(t.round == r for t in trials) for r in range(3)] == [4, 2, 1]


def test_broadcast_sizes_count_what_is_inside(spark):
    row = (b"x" * 5000, ["y" * 100] * 60, {"k": "z" * 3000}, ("w" * 2000, [["v" * 10] * 50]), None)
    df = spark.createDataFrame([row], "b binary, a array<string>, m map<string,string>, s struct<t:string,n:array<array<string>>>, e array<binary>")
    size = df.select(skew._row_bytes(df)).first()[0]
    assert 5000 + 6000 + 3000 + 2000 + 500 < size < 20_000
    assert skew.is_small(df, size) and not skew.is_small(df, size - 1)
    assert skew.is_small(df.limit(0), 0)


def test_salts_follow_the_rows_of_a_key(spark):
    df = classes(spark, {"a": 95, "b": 7, "d": 2})
    assert {r["c"]: r["_salts"] for r in skew.hot_keys(df, "c", most=10).collect()} == {"a": 10}
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "c string, v int")
    plain = sorted(map(str, df.join(dim, "c", "left").collect()))
    assert sorted(map(str, skew.lookup(df, dim, "c", limit=0).select("c", *df.drop("c").columns, "v").collect())) == plain
