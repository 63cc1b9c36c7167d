"""Rolling statistics against a loop, on ties, edges, train/test mixes and cut groups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.rolling import rolling

HOUR = 3600 * 10**6
START = dt.datetime(2024, 1, 1)
SCHEMA = "k long, p string, ts timestamp, a int, kind string, test boolean"


def at(us):
    return START + dt.timedelta(microseconds=us)


def brute(rows, mode, width=3 * HOUR):
    """Straight from the definition: the frame of each row, by looping over all rows."""
    out = {}
    for k, p, us, a, kind, test in rows:
        if p is None or us is None:
            out[k] = (0, 0.0, 1)
            continue
        mates = [r for r in rows if r[1] == p and r[2] is not None]
        trained = any(not r[5] for r in mates)
        frame = []
        for r in mates:
            before = (r[2], r[5], r[0]) < (us, test, k)
            if test and mode == "train_only":
                seen = not r[5] and r[2] < us
            elif test:
                seen = before
            else:
                seen = before and not r[5]
            if seen and r[2] >= us - width:
                frame.append(r)
        if not frame or (test and not trained):
            out[k] = (0, 0.0, 1)
        else:
            out[k] = (len(frame), sum(r[3] for r in frame) / len(frame), len({r[4] or "UNKNOWN" for r in frame}))
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, p, None if us is None else at(us), a, kind, test) for k, p, us, a, kind, test in rows], SCHEMA
    )


def run(df, **options):
    out = rolling(df, "p", "ts", "k", "a", "kind", **options)
    return {
        r["k"]: (r["platform_volume_3h"], r["platform_auto_fraction_3h"], r["platform_content_type_div_3h"])
        for r in out.collect()
    }


def random_rows(n, seed, grain=HOUR // 4):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        p = rng.choice(["hot"] * 4 + ["b", "c", "only_test", None])
        us = None if rng.random() < 0.03 else rng.randrange(0, 30 * HOUR, grain)
        rows.append((k, p, us, rng.randrange(2), rng.choice(["x", "y", "z", None]), p == "only_test" or rng.random() < 0.3))
    return rows


@pytest.mark.parametrize("mode", ["all_prior", "train_only"])
@pytest.mark.parametrize("max_rows", [5_000_000, 20])
def test_random_rows_with_ties(spark, mode, max_rows):
    rows = random_rows(600, 7)
    assert run(frame(spark, rows), mode=mode, is_test="test", max_rows=max_rows) == brute(rows, mode)


@pytest.mark.parametrize("max_rows", [5_000_000, 30])
def test_one_moment_holds_all_rows(spark, max_rows):
    rows = [(k, "p", 5 * HOUR, k % 2, f"t{k % 3}", k % 4 == 0) for k in range(300)]
    assert run(frame(spark, rows), is_test="test", max_rows=max_rows) == brute(rows, "all_prior")


def test_frame_edges(spark):
    t = 10 * HOUR
    rows = [
        (1, "p", t - 3 * HOUR, 1, "x", False),  # exactly W old: in
        (2, "p", t - 3 * HOUR - 1, 1, "y", False),  # a microsecond older: out
        (3, "p", t, 0, "z", False),  # earlier tie
        (4, "p", t, 1, "x", False),
        (5, "p", t, 1, "x", True),  # test tie: sees the train ties
        (6, "p", t + 1, 0, "y", False),  # sees no test row
        (7, "q", t, 1, "x", True),  # no train row at all
        (8, None, t, 1, "x", False),
        (9, "p", None, 1, "x", False),
    ]
    got = run(frame(spark, rows), is_test="test")
    assert got == brute(rows, "all_prior")
    assert got[3] == (1, 1.0, 1) and got[4][0] == 2 and got[5][0] == 3 and got[6][0] == 2
    assert got[7] == got[8] == got[9] == (0, 0.0, 1)


def test_train_rows_do_not_depend_on_test_rows(spark):
    rows = random_rows(300, 3)
    train = [r for r in rows if not r[5]]
    mixed = run(frame(spark, rows), is_test="test")
    alone = run(frame(spark, train), is_test="test")
    assert alone == {k: mixed[k] for k in alone}


def test_order_and_partitions_do_not_matter(spark):
    df = frame(spark, random_rows(300, 5))
    shuffled = df.repartition(7, "a").orderBy(F.rand(1))
    assert run(df, is_test="test") == run(shuffled, is_test="test") == run(df, is_test="test", max_rows=25)


def test_history_counts_once_and_is_not_returned(spark):
    rows = [(k, p, us, a, kind, False) for k, p, us, a, kind, _ in random_rows(400, 11)]
    cut = 15 * HOUR
    batch = [r for r in rows if r[2] is not None and r[2] >= cut]
    history = [r for r in rows if r[2] is None or r[2] < cut + HOUR]  # overlaps the batch
    want = {r[0]: brute(rows, "all_prior")[r[0]] for r in batch}
    got = run(frame(spark, batch), history=frame(spark, history))
    assert got == want


def test_string_keys_break_ties(spark):
    df = frame(spark, [(k, "p", 0, 1, "x", False) for k in range(12)]).withColumn("k", F.concat(F.lit("id"), "k"))
    got = run(df, max_rows=4)
    order = sorted(got)
    assert [got[k][0] for k in order] == list(range(12))


def test_one_exchange_for_the_rows(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    out = rolling(events, "user_id", "ts", "event_id", F.col("event_type") == "click", "event_type")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "SinglePartition" not in plan and "Python" not in plan


def test_unused_columns_are_not_read(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    out = rolling(events, "user_id", "ts", "event_id", F.col("event_type") == "click", "event_type")
    plan = out.select("event_id", "platform_volume_3h")._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[-1]
