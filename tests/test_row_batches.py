import pytest

from tidemark.streaming import row_batches as rb

SCHEMA = "k long, v string, gone int"


def write(spark, path, name, first, n, group_rows=None):
    """One chunk file of n rows; a few rows to each row group."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = pa.table({"k": pa.array(range(first, first + n), pa.int32()), "v": [f"é{i}" if i % 5 else None for i in range(n)]})
    path.mkdir(parents=True, exist_ok=True)
    pq.write_table(rows, path / name, row_group_size=group_rows or max(n, 1))


def run(spark, tmp_path, seen, rows=7, fail_at=None):
    stream = rb.read_row_batches(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, str(tmp_path / "progress"), rows)

    def keep(df, i):
        got = [tuple(r) for r in df.orderBy("k").collect()]
        if fail_at is not None and i == fail_at:
            raise RuntimeError("lost")
        if got:
            seen[i] = got

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "ckpt")).start()
    rb.drain(query)


def test_rows_per_batch(spark, tmp_path):
    write(spark, tmp_path / "in", "a.parquet", 0, 17, 5)  # more than two batches, over several row groups
    write(spark, tmp_path / "in", "b.parquet", 17, 0)
    write(spark, tmp_path / "in" / "c", "c.parquet", 17, 7)
    write(spark, tmp_path / "in", "_hidden.parquet", 500, 3)
    seen = {}
    run(spark, tmp_path, seen)
    assert [[r[0] for r in seen[i]] for i in sorted(seen)] == [list(range(7)), list(range(7, 14)), [14, 15, 16], list(range(17, 24))]
    assert seen[0][:2] == [(0, None, None), (1, "é1", None)]
    # A chunk that comes later is read by a new run; nothing is read twice.
    write(spark, tmp_path / "in", "d.parquet", 24, 9, 4)
    run(spark, tmp_path, seen)
    assert [r[0] for i in sorted(seen) for r in seen[i]] == list(range(33))


def test_a_failed_batch_is_read_again(spark, tmp_path):
    write(spark, tmp_path / "in", "a.parquet", 0, 30, 8)
    seen = {}
    with pytest.raises(Exception, match="lost"):
        run(spark, tmp_path, seen, rows=8, fail_at=2)
    assert sorted(seen) == [0, 1]
    run(spark, tmp_path, seen, rows=8)
    assert [[r[0] for r in seen[i]] for i in sorted(seen)] == [list(range(8)), list(range(8, 16)), list(range(16, 24)), list(range(24, 30))]


def test_nothing_there(spark, tmp_path):
    seen = {}
    run(spark, tmp_path, seen)
    assert seen == {}
    with pytest.raises(ValueError):
        rb.RowBatchReader(spark.createDataFrame([], SCHEMA).schema, {"path": "x", "rows": "0", "progress": "y"})


def test_many_batches_at_once(spark, tmp_path):
    """Batches of a chunk that share a micro-batch keep their rows and say which they are, also after a restart."""
    write(spark, tmp_path / "in", "a.parquet", 0, 500, 3)
    write(spark, tmp_path / "in", "b.parquet", 500, 4)
    schema = spark.createDataFrame([], "k long, first long").schema
    seen = []

    def run_on(at_once):
        stream = rb.read_row_batches(spark, str(tmp_path / "in"), schema, str(tmp_path / "progress"), 7, at_once, "first")
        rb.drain(stream.writeStream.foreachBatch(lambda df, i: seen.append(df.collect())).option("checkpointLocation", str(tmp_path / "ckpt")).start())

    run_on(30)
    assert [len(x) for x in seen if x] == [210, 210, 80, 4]
    assert sorted((r["k"], r["first"]) for x in seen for r in x) == [(k, k - k % 7) for k in range(500)] + [(k, 0) for k in range(500, 504)]
    reader = rb.RowBatchReader(schema, {"path": str(tmp_path / "in"), "rows": "7", "batches": "30", "progress": str(tmp_path / "p")})
    parts = reader.partitions({"chunk": "a.parquet", "row": 210}, {"chunk": "a.parquet", "row": 420})
    assert 1 < len(parts) <= rb.PARTS and parts[0].first == 210
    assert all(a.last == b.first for a, b in zip(parts, parts[1:])) and parts[-1].last == 420
