import datetime as dt
import random

from tidemark.operators import rolling
from tidemark.streaming import keyed

START = dt.datetime(2024, 1, 1)
SCHEMA = "row_id long, p string, ts timestamp, auto int, kind string, note string"
STATS = ["platform_volume_3h", "platform_auto_fraction_3h", "platform_content_type_div_3h"]


def rows(n, seed=3):
    """In order of time, with ties, gaps, nulls and texts that need care in JSON."""
    draw, out, at = random.Random(seed), [], 0
    for i in range(n):
        at += draw.choice((0, 0, 1, 7 * 60, 11 * 60, 10 * 3600 if i % 90 == 89 else 60))
        ts = None if i % 41 == 40 else START + dt.timedelta(seconds=at, microseconds=i % 3)
        out.append((i, draw.choice(["a", "b", "b", "b", None]), ts, draw.choice([0, 1, None]), draw.choice(["x", "y", "z", None]), draw.choice(['"q\\', "é\n", None])))
    return out


def shuffled(data, window=12, seed=9):
    draw = random.Random(seed)
    order = sorted(range(len(data)), key=lambda i: i + draw.random() * window)
    return [data[i] for i in order]


def flush(data):
    """A far later row, so that the watermark passes all others."""
    return (10**9, "flush", max(r[2] for r in data if r[2]) + dt.timedelta(days=9), 0, None, None)


def write(spark, data, path, parts):
    size = -(-len(data) // parts)
    for i in range(parts):
        spark.createDataFrame(data[i * size : (i + 1) * size], SCHEMA).coalesce(1).write.parquet(f"{path}/c={i}")


def run(spark, path, out, ckpt, history=None):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    scored = keyed.rolling_stream(stream, "p", "ts", "row_id", "auto", "kind", delay="40 minutes", history=history)
    query = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def expected(spark, data, history=None):
    df = spark.createDataFrame(data, SCHEMA)
    past = None if history is None else spark.createDataFrame(history, SCHEMA)
    return sorted(map(str, rolling.rolling(df, "p", "ts", "row_id", "auto", "kind", history=past).select(*df.columns, *STATS).collect()))


NAMES = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def got(spark, out):
    df = spark.read.parquet(out).where("row_id < 1000000000")
    return sorted(map(str, df.select(*NAMES, *STATS).collect()))


def test_rows_in_any_order_equal_the_batch(spark, tmp_path):
    data = rows(400)
    write(spark, [*shuffled(data), flush(data)], f"{tmp_path}/in", 4)
    query = run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 0
    assert got(spark, f"{tmp_path}/out") == expected(spark, data)
    # Buckets that the watermark has passed hold nothing any more.
    left = keyed.read_state(spark, f"{tmp_path}/ckpt")
    assert left.select("key._g").distinct().collect() == [("flush",)]


def test_a_restart_changes_nothing(spark, tmp_path):
    data = rows(300, 5)
    mixed = shuffled(data)
    write(spark, mixed[:140], f"{tmp_path}/in/first", 2)
    source = f"{tmp_path}/in/*"
    run(spark, source, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    early = len(got(spark, f"{tmp_path}/out"))
    write(spark, [*mixed[140:], flush(data)], f"{tmp_path}/in/then", 2)
    run(spark, source, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    assert 0 < early < 140
    assert got(spark, f"{tmp_path}/out") == expected(spark, data)


def test_state_starts_from_a_table(spark, tmp_path):
    data = [r for r in rows(320, 7) if r[2] is not None]
    past, live = data[:200], data[195:]  # five rows are in both
    write(spark, [*live, flush(data)], f"{tmp_path}/in", 2)
    history = spark.createDataFrame(past, SCHEMA)
    first = f"{tmp_path}/first"
    write(spark, live[:1], f"{first}/in", 1)
    run(spark, f"{first}/in", f"{first}/out", f"{first}/ckpt", history)
    held = keyed.read_state(spark, f"{first}/ckpt")
    recent = {r[0] for r in past if r[1] is not None and r[2] > live[0][2] - dt.timedelta(hours=2)}
    assert recent and recent <= {r["k"] for r in held.where("past").collect()}
    run(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt", history)
    assert got(spark, f"{tmp_path}/out") == expected(spark, live, past)


def test_frame_stats():
    import numpy as np

    volume, flagged, kinds = keyed.frame_stats(np.array([0, 0, 5, 10, 11]), np.array([1, 0, 1, 0, 0]), np.array(["x", "x", "y", "x", "z"]), 10)
    assert (volume.tolist(), flagged.tolist(), kinds.tolist()) == ([0, 1, 2, 3, 2], [0, 1, 1, 2, 1], [0, 1, 1, 2, 2])
    assert all(len(x) == 0 for x in keyed.frame_stats(np.zeros(0, int), np.zeros(0, int), np.zeros(0, str), 10))
