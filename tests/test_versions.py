import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.plans import training
from tidemark.plans.features import Spec
from tidemark.sources import files, store, versions


def put(spark, root, value):
    return versions.commit(spark, root, lambda p: spark.createDataFrame([(value,)], "v int").write.parquet(p), {"note": str(value)})


def value(spark, root):
    return spark.read.parquet(versions.latest(spark, root)["path"]).first()["v"]


def test_a_writer_that_dies_leaves_no_version(spark, tmp_path):
    root = str(tmp_path / "g")
    assert versions.latest(spark, root) is None
    put(spark, root, 1)

    def half(path):
        spark.createDataFrame([(2,)], "v int").write.parquet(f"{path}/first-part")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        versions.commit(spark, root, half)
    assert versions.numbers(spark, root) == [1] and value(spark, root) == 1
    put(spark, root, 3)
    assert versions.numbers(spark, root) == [1, 2] and value(spark, root) == 3 and versions.latest(spark, root)["note"] == "3"


def test_two_writers_never_get_one_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "g")
    put(spark, root, 0)
    # Both see the same newest version before either puts its manifest.
    met = threading.Barrier(2)
    listed = versions.numbers

    def together(*args):
        known = listed(*args)
        met.wait(60)
        return known

    monkeypatch.setattr(versions, "numbers", together)
    got = []
    writers = [threading.Thread(target=lambda v=v: got.append(put(spark, root, v))) for v in (1, 2)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    monkeypatch.setattr(versions, "numbers", listed)
    assert sorted(m["version"] for m in got) == [2, 3] == versions.numbers(spark, root)[1:]
    assert {spark.read.parquet(m["path"]).first()["v"] for m in got} == {1, 2}
    for m in got:
        assert versions.manifest(spark, root, m["version"])["token"] == m["token"]


def test_readers_see_whole_groups(spark, tmp_path):
    root = str(tmp_path)
    for k in (1, 2):
        store.write_feature_group(spark.createDataFrame([(i, k) for i in range(5)], "row_id long, n long"), root, "g", 1, "row_id")
        assert {r["n"] for r in store.read_feature_group(spark, root, "g", 1).collect()} == {k}
    with pytest.raises(FileNotFoundError):
        store.read_feature_group(spark, root, "g", 2)


def test_the_registry_keeps_whole_bundles(spark, tmp_path):
    root = str(tmp_path)
    rows = [(i, float(i % 2), float(i)) for i in range(40)]
    data = models.encode_features(spark.createDataFrame(rows, "k long, label double, x double"), ["x"])
    model = models.fit_logistic(data, max_iter=3)
    codes = spark.createDataFrame([("c", "a", 0)], "column string, value string, code int")
    bundle = training.Bundle(["a", "b"], codes, codes, [0.5, 0.5], None, model, {"t": spark.createDataFrame([("w", 0, 2, 1.5)], "term string, idx int, df long, idf double")}, "hard", Spec())
    assert store.save_model(bundle, {"macro_f1": 0.4}, root, "two", spark) == 1
    assert store.save_model(model, {"macro_f1": 0.3}, root, "plain", spark) == 1
    best = store.best_model(store.read_registry(spark, root), "macro_f1").first()
    again = training.Bundle.load(spark, best["path"])
    assert (best["name"], again.labels, again.rule, again.prior) == ("two", ["a", "b"], "hard", [0.5, 0.5])
    assert again.vocabularies["t"].first()["term"] == "w" and again.codes.count() == 1
    both = again.model.transform(data).select("k", F.col("probability").cast("string").alias("p")).collect()
    assert both == model.transform(data).select("k", F.col("probability").cast("string").alias("p")).collect()
    other = store.read_registry(spark, root).where("name = 'plain'").first()
    assert isinstance(PipelineModel.load(other["path"]), PipelineModel)
    # A bundle saved by itself is a version of its folder.
    bundle.save(f"{root}/own")
    bundle.rule = "argmax"
    bundle.save(f"{root}/own")
    assert training.Bundle.load(spark, f"{root}/own").rule == "argmax" and versions.numbers(spark, f"{root}/own") == [1, 2]


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).withColumn("x", F.col("id") * 2).repartition(3).write.parquet(f"{tmp_path}/a")
    spark.range(7).withColumn("x", F.col("id")).write.parquet(f"{tmp_path}/b")
    paths = [f"{tmp_path}/a", f"{tmp_path}/b"]
    row, plan = files.footer_aggregate(spark, paths, F.count(F.lit(1)).alias("n"), F.max("x").alias("top"))
    assert (row["n"], row["top"]) == (1007, 1998)
    assert "PushedAggregation: [COUNT(*), MAX(x)]" in plan
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert files.estimate_rows(spark, paths) == 1007 and spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "parquet" in before
