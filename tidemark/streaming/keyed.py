"""Rolling statistics of a stream in keyed state, emitted in order of event time.

The statistics are those of `operators.rolling`: rows of the same group in the last hours before a row, itself not
counted, ties in order of their key. A row waits in state until the watermark has passed its time, so rows may arrive in
any order within the watermark's delay; later ones are dropped by the engine and counted there.

State is kept by (group, bucket of `hours`). A frame touches its own bucket and the one before, so each row is sent to
its own bucket, to be scored, and to the next one, as context only: no state grows beyond two buckets of a group, groups
are parallel over time, and a bucket's state is gone once the watermark has passed its end. An event-time timer wakes a
bucket at its first waiting row. The engine checkpoints state by batch, so a restart or a replayed batch goes on from the
same rows. A history table can be handed over as initial state, and state can be read back as a table.

Python workers are used, a group at a time, with rows in Arrow batches; a waking bucket reads its rows once and writes
back what is left. `live.process_batch` does the same work without Python, one micro-batch after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.parse import micros
from tidemark.operators.rolling import COLD, DIVERSITY, FRACTION, HOUR_MICROS, VOLUME
from tidemark.session import importable

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def frame_stats(us: np.ndarray, auto: np.ndarray, kind: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Volume, flagged rows and different kinds in the frame before each of the rows, which are in order."""
    n = len(us)
    start = np.searchsorted(us, us - width, "left")
    flagged = np.concatenate([[0], np.cumsum(auto)])
    codes = np.unique(kind, return_inverse=True)[1]
    # Sweep: a kind counts while it has rows in the frame.
    present = [0] * (int(codes.max(initial=-1)) + 1)
    kinds, many, low = np.zeros(n, np.int64), 0, 0
    numbers = codes.tolist()
    for i, first in enumerate(start.tolist()):
        while low < first:
            present[numbers[low]] -= 1
            many -= present[numbers[low]] == 0
            low += 1
        kinds[i] = many
        many += present[numbers[i]] == 0
        present[numbers[i]] += 1
    return np.arange(n) - start, flagged[np.arange(n)] - flagged[start], kinds


class Rolling(StatefulProcessor):
    """State of one (group, bucket): rows that wait to be scored, and rows that those look back on."""

    def __init__(self, rows: str, width: int) -> None:
        self.schema, self.names, self.width = rows, T.StructType.fromDDL(rows).names, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self.alarm = handle.getValueState("alarm", "at long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        self._take(key, initialState)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        for part in rows:
            self._take(key, part)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.alarm.clear()
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = pd.DataFrame(list(self.rows.get()), columns=self.names)
        # A row that came with the stream stands for its copy in the history.
        held = held[~held["past"].astype(bool) | ~held["k"].isin(held.loc[~held["past"].astype(bool), "k"])]
        held = held.sort_values(["us", "k"], kind="stable")
        ready = (held["us"] <= passed).to_numpy(bool)
        known, waiting = held[ready], held[~ready]
        stats = frame_stats(known["us"].to_numpy(np.int64), known["a"].to_numpy(np.int64), known["kind"].to_numpy(str), self.width)
        own = known["own"].to_numpy(bool)
        volume, flagged, kinds = (x[own] for x in stats)
        out = pd.DataFrame({"payload": known["payload"].to_numpy()[own]})
        out["volume"] = np.where(volume > 0, volume, COLD[0])
        out["share"] = np.where(volume > 0, flagged / np.maximum(volume, 1), COLD[1])
        out["kinds"] = np.where(volume > 0, kinds, COLD[2])
        end = int(key[1]) + self.width
        if passed >= end:  # rows of this bucket come no more
            self.rows.clear()
        else:
            # What has been scored stays as context, as far as a later row can look back.
            later = known[known["us"] >= passed - self.width].assign(own=False, payload=None)
            self._put(pd.concat([later, waiting]))
            self._wake(key, waiting)
        if len(out):
            yield out

    def close(self) -> None:
        pass

    def _take(self, key, part: pd.DataFrame) -> None:
        rows = part[self.names]
        if len(rows):
            self.rows.appendList(_tuples(rows))
            self._wake(key, rows)

    def _put(self, rows: pd.DataFrame) -> None:
        if len(rows):
            self.rows.put(_tuples(rows))
        else:
            self.rows.clear()

    def _wake(self, key, rows: pd.DataFrame) -> None:
        """Set the timer to the first of `rows` to be scored, at the latest to the end of the bucket, if it is set later."""
        first = rows.loc[rows["own"].astype(bool), "us"]
        at = -(-min(int(first.min()) if len(first) else 1 << 62, int(key[1]) + self.width) // 1000)
        old = self.alarm.get()[0] if self.alarm.exists() else None
        if old is None or at < old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(at)
            self.alarm.update((at,))


def _tuples(rows: pd.DataFrame) -> list[tuple]:
    return [tuple(None if v is None or v != v else v for v in r) for r in rows.astype(object).itertuples(index=False, name=None)]


def rolling_stream(
    stream: DataFrame,
    group: str,
    ts: str,
    key: str,
    auto: Column | str,
    kind: Column | str,
    hours: float = 3,
    delay: str = "1 hour",
    history: DataFrame | None = None,
    prefix: str = "platform_",
) -> DataFrame:
    """The rows of a stream with `<prefix>volume_3h`, `..auto_fraction_3h` and `..content_type_div_3h`, in append mode.

    Rows come out when the watermark, `delay` behind the newest time seen, has passed them. `history` rows (a table with
    the same columns) are there from the start and never come out; of a key that is in both, the stream's row counts.
    Rows without group or time come out at once with the cold defaults. Times are kept to the microsecond.
    """
    spark = importable(stream.sparkSession)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    width = int(hours * HOUR_MICROS)
    flag = F.coalesce((F.col(auto) if isinstance(auto, str) else auto).cast("long"), F.lit(0).cast("long"))
    kinds = F.coalesce((F.col(kind) if isinstance(kind, str) else kind).cast("string"), F.lit("UNKNOWN"))
    payload = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
    as_text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    key_type = stream.schema[key].dataType.simpleString()

    def dealt(df: DataFrame, own: bool) -> DataFrame:
        bucket = micros(ts) - F.pmod(micros(ts), F.lit(width))
        text = as_text if own else F.lit(None).cast("string")
        here = F.struct(bucket.alias("b"), F.lit(own).alias("own"), text.alias("payload"))
        after = F.struct((bucket + width).alias("b"), F.lit(False).alias("own"), F.lit(None).cast("string").alias("payload"))
        dated = df.where(F.col(group).isNotNull() & micros(ts).isNotNull())
        rows = dated.select(
            F.col(group).cast("string").alias("_g"), F.col(ts).cast("timestamp").alias("_at"), micros(ts).alias("us"), F.col(key).alias("k"),
            flag.alias("a"), kinds.alias("kind"), F.lit(not own).alias("past"), F.explode(F.array(here, after)).alias("side"),
        )
        return rows.select("_g", F.col("side.b").alias("_b"), "_at", "us", "k", "a", "kind", "past", "side.own", "side.payload")

    rows = f"us long, k {key_type}, a long, kind string, past boolean, own boolean, payload string"
    # The watermark goes by the time column itself, so it is set before rows are dealt out.
    waiting = dealt(stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay), True).groupBy("_g", "_b")
    start = None if history is None else dealt(history, False).groupBy("_g", "_b")
    out = waiting.transformWithStateInPandas(
        Rolling(rows, width), "payload string, volume long, share double, kinds long", "Append", "EventTime", start
    )
    names = [prefix + VOLUME, prefix + FRACTION, prefix + DIVERSITY]
    back = F.from_json("payload", payload, {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    scored = out.select(back.alias("row"), *[F.col(c).alias(n) for c, n in zip(("volume", "share", "kinds"), names, strict=True)])
    undated = stream.where(F.col(group).isNull() | micros(ts).isNull())
    cold = [F.lit(v).cast(t).alias(n) for v, t, n in zip(COLD, ("long", "double", "long"), names, strict=True)]
    return scored.select("row.*", *names).unionByName(undated.select(*stream.columns, *cold))


def read_state(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Rows held in the state of a stopped stream, with their group `key._g` and bucket `key._b`."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    state = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", "rows").load(checkpoint)
    return state.select("key", "list_element.*")
