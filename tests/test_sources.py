import datetime as dt
import gzip

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from tidemark.sources import files, schema, store


def write(path, **columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), path)
    return str(path)


def test_widening():
    i, l, f, d, s, n = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.NullType()
    cases = [(i, i, i), (i, l, l), (i, f, d), (f, l, d), (f, d, d), (n, d, d), (s, n, s), (i, s, s),
             (T.DateType(), T.TimestampType(), s), (T.BooleanType(), i, s)]
    for a, b, want in cases:
        assert schema.unify_type(a, b) == want and schema.unify_type(b, a) == want


def test_merged_columns_are_sorted_old_before_new():
    number = T.IntegerType()
    a = T.StructType().add("z", number).add("b", number)
    b = T.StructType().add("y", number).add("a", number).add("z", T.StringType())
    merged = schema.merge_schemas([a, b])
    assert [(f.name, f.dataType.simpleString()) for f in merged] == [
        ("b", "int"), ("z", "string"), ("a", "int"), ("y", "int")
    ]


def test_files_that_drifted(spark, tmp_path):
    paths = [
        write(tmp_path / "a.parquet", k=pa.array([1, 2], pa.int32()), v=[1, 2]),
        write(tmp_path / "b.parquet", v=[0.5], k=pa.array([3], pa.int64())),
        write(tmp_path / "c.parquet", k=pa.array([4], pa.int64()), v=["x"], extra=[True]),
        write(tmp_path / "d.parquet", extra=[False], k=pa.array([5], pa.int64())),
        write(tmp_path / "e.parquet", k=pa.array([6], pa.int32()), v=[7]),
    ]
    got = files.read_statements(spark, paths)
    assert {f.name: f.dataType.simpleString() for f in got.schema} == {"k": "bigint", "v": "string", "extra": "boolean"}
    rows = {r["k"]: (r["v"], r["extra"]) for r in got.collect()}
    assert rows == {1: ("1", None), 2: ("2", None), 3: ("0.5", None), 4: ("x", True), 5: (None, False), 6: ("7", None)}


def test_single_file_is_the_plain_scan(spark, tmp_path):
    path = write(tmp_path / "a.parquet", z=[1], a=[2])
    assert files.read_statements(spark, path).columns == ["z", "a"]


def test_csv_headers_in_other_order_and_gzip(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("v,k\nz,3\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write("k,v\n4,w\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv", "c.csv.gz")]
    rows = {r["k"]: r["v"] for r in files.read_statements(spark, paths).collect()}
    assert rows == {1: "x", 2: "y", 3: "z", 4: "w"}
    counts = {r["path"].rsplit("/", 1)[1]: r["rows"] for r in files.count_rows(spark, paths).collect()}
    assert counts == {"a.csv": 2, "b.csv": 1, "c.csv.gz": 1}


def test_unreadable_file_counts_zero(spark, tmp_path):
    good = write(tmp_path / "a.parquet", k=[1, 2, 3])
    (tmp_path / "b.parquet").write_bytes(b"not parquet at all")
    counts = {r["path"].rsplit("/", 1)[1]: r["rows"] for r in files.count_rows(spark, [good, str(tmp_path / "b.parquet")]).collect()}
    assert counts == {"a.parquet": 3, "b.parquet": 0}


def test_discovery(spark, tmp_path):
    write(tmp_path / "x" / "y" / "a.parquet", k=[1])
    write(tmp_path / "x" / "B.PARQUET", k=[1])
    (tmp_path / "x" / "c.csv").write_text("k\n1\n")
    (tmp_path / "x" / ".hidden.csv").write_text("k\n1\n")
    (tmp_path / "x" / "readme.txt").write_text("no")
    found = [r["path"].split("/x/")[1] for r in files.discover(spark, str(tmp_path / "x")).collect()]
    assert found == ["B.PARQUET", "c.csv", "y/a.parquet"]


def test_dump_range(spark, tmp_path):
    days = spark.sql("select explode(sequence(date'2024-01-01', date'2024-01-10')) as day").where("day <> date'2024-01-04'")
    files.write_statements(days.withColumn("k", F.lit(1)), str(tmp_path / "d"))
    got = files.read_dump(spark, str(tmp_path / "d"), dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert {r["day"].day for r in got.collect()} == {3, 5}
    assert "PartitionFilters: [isnotnull(day" in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        files.days_between(got, dt.date(2024, 1, 5), dt.date(2024, 1, 3))
    assert files.latest_day(days, dt.date(2024, 1, 5)) == dt.date(2024, 1, 3)
    with pytest.raises(LookupError):
        files.latest_day(days, dt.date(2024, 3, 1))


def test_tail_grows_until_the_span_is_long_enough(spark):
    rows = [(f"c{i:02d}", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=30 * i)) for i in range(12)]
    df = spark.createDataFrame(rows, "chunk string, ts timestamp")
    names = lambda d: sorted({r["chunk"] for r in d.collect()})
    assert names(files.tail_chunks(df, 2)) == ["c10", "c11"]
    assert len(names(files.tail_for_span(df, "ts", 3))) == 8  # 7 steps of 30 minutes
    assert len(names(files.tail_for_span(df, "ts", 100))) == 12
    assert len(names(files.tail_for_span(df, "ts", 0))) == 2


def test_feature_group_keeps_the_first_of_a_key(spark, tmp_path):
    rows = [("a", 2, "2024-01-01"), ("a", 1, "bad"), ("b", 5, "2024-01-02 03:00:00")]
    df = spark.createDataFrame(rows, "row_id string, n int, at string")
    store.write_feature_group(df, str(tmp_path), "g", 1, "row_id", "at", ["n"])
    got = store.read_feature_group(spark, str(tmp_path), "g", 1)
    assert got.schema["n"].dataType == T.LongType() and got.schema["at"].dataType == T.TimestampType()
    assert {r["row_id"]: (r["n"], r["at"]) for r in got.collect()} == {"a": (1, None), "b": (5, dt.datetime(2024, 1, 2, 3))}


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("case when id % 3 < 2 then 'a' else concat('b', id) end as k", "id")
    plan = store.first_by_key(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_bucketed_groups_join_without_a_shuffle(spark, tmp_path):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).select(F.col("id").cast("string").alias("row_id"), F.col("id").alias("n"))
        one = store.write_feature_group(df, str(tmp_path), "one", 1, "row_id", buckets=4)
        two = store.write_feature_group(df.withColumnRenamed("n", "m").where("m < 400"), str(tmp_path), "two", 1, "row_id", buckets=4)
        view = store.feature_view(spark.table(one), [spark.table(two)], "row_id")
        assert "Exchange" not in view._jdf.queryExecution().executedPlan().toString()
        assert view.count() == 500 and view.where("m is null").count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_registry_versions(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml import PipelineModel

    model = PipelineModel([VectorAssembler(inputCols=["a"], outputCol="b")])
    root = str(tmp_path)
    assert store.read_registry(spark, root).count() == 0
    assert [store.save_model(model, {"macro_f1": f}, root, "m", spark) for f in (0.4, 0.7, 0.7)] == [1, 2, 3]
    best = store.best_model(store.read_registry(spark, root), "macro_f1").first()
    assert (best["version"], best["value"]) == (3, 0.7)
    assert store.best_model(store.read_registry(spark, root), "macro_f1", "min").first()["version"] == 1
