"""Statistics of the last hours per group, free of leakage from test rows into train rows.

For a row at time t the frame is [t - W, the row itself): rows exactly W old and earlier ties count, later ties
and the row do not. Ties go by train before test, then by key.

The frame has a time-based start and a row-based end, which no built-in frame offers, and a count of distinct
kinds over a moving frame is not offered either. So the rows are swept in time order instead: a row adds itself
when it happens and takes itself out W later, after the rows of that very moment. Every statistic is then a
running sum of signed weights, read just before the row:

  volume   of +1 / -1
  flagged  of +flag / -flag
  kinds    of +1 when the running count of a kind leaves 0, -1 when it falls back to 0

Rows are grouped by (group, floor(t / W)). A frame touches at most two such buckets, so each row also leaves a
narrow "departing" copy in the next bucket, and no bucket needs to know the ones before. Buckets that hold too
many rows are cut into ordered cells (see `skew.with_cells`), so that not even one burst lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.parse import has_clock_time, micros
from tidemark.operators.skew import GROUP_ROWS, lookup, place, running_sums, with_cells

HOUR_MICROS = 3_600_000_000
VOLUME, FRACTION, DIVERSITY = "volume_3h", "auto_fraction_3h", "content_type_div_3h"
COLD = (0, 0.0, 1)  # fixed values: what a row without history gets


def any_clock_time(df: DataFrame, ts: str) -> bool:
    """Whether any timestamp has a time of day; without one a window of hours says nothing."""
    found = df.where(has_clock_time(ts)).select(F.lit(1)).limit(1).collect()
    return bool(found)


def rolling(
    df: DataFrame,
    group: str,
    ts: str,
    key: str,
    auto: Column | str,
    kind: Column | str,
    hours: float = 3,
    mode: str = "all_prior",
    is_test: str | None = None,
    history: DataFrame | None = None,
    max_rows: int = GROUP_ROWS,
    prefix: str = "platform_",
    packed: bool = False,
) -> DataFrame:
    """Add `<prefix>volume_3h`, `<prefix>auto_fraction_3h` and `<prefix>content_type_div_3h`.

    `mode` says what test rows look back on: "all_prior" (train and earlier test rows) or "train_only".
    `history` rows (any frame with the same named columns) warm the windows but are not returned; a key that is in
    both counts once. Rows without group or time keep the cold defaults, and so do test rows of a group without
    train rows.

    With `packed` the columns of a row travel as one value: exchange, sorts and windows copy it in one piece, and a departing
    copy has none. Columns that nobody reads afterwards are then not left out.
    """
    if mode not in ("all_prior", "train_only"):
        raise ValueError(f"unknown mode {mode!r}")
    flag = (F.col(auto) if isinstance(auto, str) else auto).cast("int")
    kind_col = F.coalesce(F.col(kind) if isinstance(kind, str) else kind, F.lit("UNKNOWN"))
    width = int(hours * HOUR_MICROS)
    if packed:
        df = df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
    names = ["_row"] if packed else df.columns
    kinds = {f.name: f.dataType for f in df.schema}

    def prepared(rows: DataFrame, given: bool) -> DataFrame:
        test = F.coalesce(F.col(is_test).cast("int"), F.lit(0)) if given and is_test else F.lit(0)
        return rows.select(
            *[F.col(f"`{c}`") if given else F.lit(None).cast(kinds[c]).alias(c) for c in names],
            F.lit(given).alias("_given"),
            F.col(group).alias("_g"),
            micros(ts).alias("_us"),
            F.col(key).alias("_k"),
            F.coalesce(flag, F.lit(0)).alias("_a"),
            kind_col.alias("_kind"),
            test.alias("_test"),
        )

    rows = prepared(df, True)
    if history is not None:
        # Test rows ask whether their group has any train row; otherwise only rows within reach of a frame matter.
        near = history if is_test else _within_reach(history, df, ts, width)
        older = near.join(df.select(key), key, "left_anti")
        past = prepared(older, False).where(F.col("_g").isNotNull() & F.col("_us").isNotNull())
        rows = rows.unionByName(past)

    dated = F.col("_g").isNotNull() & F.col("_us").isNotNull()
    # Undated rows need no frame: spread them over invented buckets instead of one huge null group.
    start = F.col("_us") - F.pmod(F.col("_us"), F.lit(width))
    bucket = F.when(dated, start).otherwise(F.pmod(F.xxhash64("_k"), F.lit(100_000)))
    happens = F.col("_out") == 0
    twice = F.when(dated, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = rows.withColumn("_out", F.explode(twice)).select(  # 0: happens, 1: departs
        *[F.when(happens, F.col(c)).alias(c) for c in names],
        "_g", "_k", "_a", "_kind", "_test", "_out",
        (happens & F.col("_given")).alias("_given"),
        dated.alias("_dated"),
        (bucket + F.col("_out") * width).alias("_b"),
        (F.col("_us") + F.col("_out") * width).alias("_at"),
    )
    # With train_only, test rows read the sums before the train rows of the same moment.
    tie = F.col("_test") if mode == "all_prior" else 1 - F.col("_test")
    events = events.withColumn("_tie", tie)

    group_keys, order = ["_g", "_b"], ["_at", "_out", "_tie", "_k"]
    cells = place(with_cells(events, group_keys, order, max_rows), group_keys)

    # Which running sums are needed: over train rows (t), over all rows (a).
    views = {"t": F.when(F.col("_test") == 0, 1).otherwise(0)}
    if is_test and mode == "all_prior":
        views["a"] = F.lit(1)
    departs = F.col("_out")
    sign = 1 - 2 * departs

    swept = running_sums(
        cells,
        [*group_keys, "_kind"],
        order,
        {f"_n_{v}": w * sign for v, w in views.items()} | {f"_m_{v}": w * departs for v, w in views.items()},
        {f"_c_{v}": w * departs for v, w in views.items()},
    )
    steps, whole = {}, {}
    for v, w in views.items():
        # Rows of this kind inside the frame just before this event, and whether the event changes "any or none".
        present = F.col(f"_c_{v}") + F.col(f"_n_{v}")
        counts = w == 1
        enters = counts & (departs == 0) & (present == 0)
        leaves = counts & (departs == 1) & (present == 1)
        first = counts & (departs == 1) & (F.col(f"_m_{v}") == 0)
        swept = swept.withColumn(
            f"_s_{v}", F.when(enters, 1).when(leaves, -1).otherwise(0)
        ).withColumn(f"_f_{v}", F.when(first, 1).otherwise(0))
        steps |= {f"_vol_{v}": w * sign, f"_auto_{v}": w * sign * F.col("_a"), f"_div_{v}": F.col(f"_s_{v}")}
        whole |= {f"_vol0_{v}": w * departs, f"_auto0_{v}": w * departs * F.col("_a"), f"_div0_{v}": F.col(f"_f_{v}")}
    done = running_sums(swept, group_keys, order, steps, whole)

    def read(name: str) -> Column:
        def at(v: str) -> Column:
            return F.col(f"_{name}_{v}") + F.col(f"_{name}0_{v}")

        return F.when(F.col("_test") == 1, at("a")).otherwise(at("t")) if "a" in views else at("t")

    done = done.where("_given")
    seen = F.col("_dated")
    if is_test:
        done = _with_train_flag(done, rows)
        seen = seen & ((F.col("_test") == 0) | F.coalesce(F.col("_has_train"), F.lit(False)))
    volume = read("vol")
    frame = seen & (volume > 0)
    return done.select(
        *([F.inline(F.array("_row"))] if packed else names),  # fields taken one by one would be taken before the sorts
        F.when(frame, volume).otherwise(COLD[0]).cast("long").alias(prefix + VOLUME),
        F.when(frame, F.try_divide(read("auto"), volume)).otherwise(COLD[1]).alias(prefix + FRACTION),
        F.when(frame, read("div")).otherwise(COLD[2]).cast("long").alias(prefix + DIVERSITY),
    )


def _within_reach(history: DataFrame, df: DataFrame, ts: str, width: int) -> DataFrame:
    """The history rows that a frame of a row of `df` can hold: not older than `width` before its first row, and not later
    than its last."""
    lo, hi = df.select(micros(ts).alias("_us")).agg(F.min("_us"), F.max("_us")).first()
    if lo is None:
        return history.where(F.lit(False))
    return history.where(micros(ts).between(lo - width, hi))


def _with_train_flag(events: DataFrame, rows: DataFrame) -> DataFrame:
    """Mark the rows whose group has train rows, wherever in time they lie."""
    trained = (
        rows.where((F.col("_test") == 0) & F.col("_us").isNotNull() & F.col("_g").isNotNull())
        .groupBy("_g")
        .agg(F.lit(True).alias("_has_train"))
    )
    return lookup(events, trained, "_g", spread_by=["_k"])
