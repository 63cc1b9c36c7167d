"""Repeatable samples: by position in the file, by hash of the row id, by stratum."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.skew import GROUP_ROWS, group_rank

_HASH_STEPS = 1 << 32


@dataclass(frozen=True)
class Rate:
    fraction: float  # share of rows to keep
    step: int  # keep every step-th row of a file, 1 where rows are drawn by hash
    stride: int  # nearest whole stride for a local file


def plan_rate(total: int, target: int) -> Rate:
    """How to reach about `target` of `total` rows.

    Up to a half the rows are taken at a whole step, so 0.4 keeps one row in three; above it they are drawn.
    """
    fraction = min(1.0, target / total) if total > 0 else 1.0
    step = 1 if fraction > 0.5 else math.ceil(1 / fraction)
    stride = max(1, round(total / target)) if 0 < target < total else 1
    return Rate(fraction, step, stride)


def stride_sample(df: DataFrame, k: int, position: Column | None = None) -> DataFrame:
    """Rows 0, k, 2k, ... of each file. Parquet scans know the position; the filter runs in the scan stage."""
    if k <= 1:
        return df
    at = position if position is not None else F.col("_metadata.row_index")
    return df.where(at % k == 0)


def with_file_position(df: DataFrame, name: str = "row_index", max_rows: int = GROUP_ROWS) -> DataFrame:
    """Position of each row in its file, for formats whose scan does not tell it (CSV)."""
    placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    return group_rank(placed, ["_file"], ["_at"], name, max_rows).drop("_file", "_at")


def in_files(df: DataFrame, order: str, rows: int, name: str = "file", max_rows: int = 1_000_000) -> DataFrame:
    """`df` with `name`, the number of a file, ready to be written by it: rows in the order of a column (nulls first, equals
    in any order), `rows` to each file and what is left to the last, each file by one task and in order.

    With `rows` a multiple of k, every k-th row of each file is every k-th row of the whole.
    """
    placed = df.withColumns({"_all": F.lit(0), "_null": F.col(order).isNotNull(), "_id": F.monotonically_increasing_id()})
    ranked = group_rank(placed, ["_all"], ["_null", order, "_id"], "_nth", max_rows)
    dealt = ranked.withColumn(name, F.floor(F.col("_nth") / rows)).repartition(name).sortWithinPartitions(name, "_nth")
    return dealt.select(*df.columns, name)


def hash_draw(*cols: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the row id and the seed alone, not on order, partitioning or engine."""
    text = F.concat_ws("|", *[(c if isinstance(c, Column) else F.col(c)).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / float(_HASH_STEPS)


def hash_sample(
    df: DataFrame, key: str, fraction: float, seed: int = 42, by: Sequence[str] = ()
) -> DataFrame:
    """Keep about `fraction` of the rows. Smaller fractions of one seed are subsets of larger ones.

    Columns in `by` (the day, say) give each of their values a draw of its own.
    """
    return df if fraction >= 1 else df.where(hash_draw(key, *by, seed=seed) < fraction)


def sample_to_target(df: DataFrame, key: str, total: int, target: int, seed: int = 42) -> DataFrame:
    """Sample a Parquet scan to about `target` rows by the rule of `plan_rate`."""
    rate = plan_rate(total, target)
    return stride_sample(df, rate.step) if rate.step > 1 else hash_sample(df, key, rate.fraction, seed)


def stratified_sample(
    df: DataFrame, by: str, n: int, key: str, seed: int = 42, order: Sequence[str] = (), max_rows: int = GROUP_ROWS
) -> DataFrame:
    """Exactly min(n, size) rows of each stratum: the first by `order`, or a hash draw where none is given.

    The limit on the rank is applied before the shuffle too, so a task sends at most `n` rows of a stratum. Where more
    than `max_rows` are asked for, strata are ranked in ordered cells instead.
    """
    ranked = df if order else df.withColumn("_draw", hash_draw(key, seed=seed))
    by_order = list(order) or ["_draw", key]
    if n <= max_rows:
        nth = F.row_number().over(Window.partitionBy(by).orderBy(*by_order))
        return ranked.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth", "_draw")
    return group_rank(ranked, [by], by_order, "_nth", max_rows).where(F.col("_nth") < n).drop("_nth", "_draw")
