from pyspark.sql import functions as F

from checks import REGISTRY
from checks.base import statements
from tidemark.plans import training


def test_undated_statements_are_scored(spark, sf):
    raw = statements(spark, sf)
    want = raw.where((F.col("created_at") >= "2024-01-25") | F.col("created_at").isNull())
    undated = raw.where("created_at is null").count()
    scored = REGISTRY["scored_statements"].run(spark, sf)
    assert undated > 0 and scored.count() == want.count()


def test_train_rows_are_spread_by_number(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k").coalesce(1)
    sizes = [len(p) for p in training.spread(rows, "k", 1000, 50).rdd.glom().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 100
    assert training.spread(rows, "k", 40, 50).rdd.getNumPartitions() == 1
