"""Guards and reports on rows, classes and columns."""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.parse import lenient_timestamp
from tidemark.operators.skew import lookup

MISSING_TEXT, MISSING_NUMBER = "__MISSING__", -1  # fixed values: the sentinels


def add_missing(df: DataFrame, texts: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """Add absent feature columns, filled with the sentinel of their kind, and warn about them."""
    absent = missing_columns(df, [*texts, *numbers])
    if absent:
        warnings.warn(f"absent columns are filled with sentinels: {absent}", stacklevel=2)
    fill = {c: F.lit(MISSING_TEXT if c in set(texts) else MISSING_NUMBER) for c in absent}
    return df.withColumns(fill) if fill else df


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in expected if c not in have]


def impute_text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(MISSING_TEXT))


def impute_number(col: str, to: str = "bigint") -> Column:
    """The number, also from text, or the sentinel."""
    return F.coalesce(F.col(col).try_cast(to), F.lit(MISSING_NUMBER).cast(to))


def empty_text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def drop_unparsed(df: DataFrame, ts: str) -> DataFrame:
    """Only rows whose date can be read."""
    return df.where(lenient_timestamp(ts).isNotNull())


# --- classes ---------------------------------------------------------------------------


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, rows, percent) by class."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("percent", F.col("rows") * 100.0 / total)


def class_summary(df: DataFrame, label: str) -> DataFrame:
    """Number of classes, smallest and largest class and their ratio."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    return counts.agg(
        F.count("*").alias("classes"),
        F.min("rows").alias("smallest"),
        F.max("rows").alias("largest"),
        (F.max("rows") / F.min("rows")).alias("imbalance"),
    )


def drop_rare(df: DataFrame, label: str, max_rows: int = 20) -> DataFrame:
    """Rows of classes with more than `max_rows` rows."""
    kept = df.groupBy(label).count().where(F.col("count") > max_rows).select(label)
    return lookup(df, kept, label, "left_semi")


def rare_classes(df: DataFrame, label: str, max_rows: int = 20) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("rows")).where(F.col("rows") <= max_rows)


def drop_classes(df: DataFrame, classes: DataFrame, label: str) -> DataFrame:
    """Rows whose class is not listed."""
    return lookup(df, classes.select(label).distinct(), label, "left_anti")


def drop_sparse(df: DataFrame, label: str, is_test: str, min_rows: int = 2) -> DataFrame:
    """Drop, from train and test alike, classes with fewer than `min_rows` train rows."""
    trained = F.sum(F.when(~F.col(is_test), 1).otherwise(0))
    kept = df.groupBy(label).agg(trained.alias("n")).where(F.col("n") >= min_rows).select(label)
    return lookup(df, kept, label, "left_semi")


def sparse_classes(df: DataFrame, label: str, is_test: str, below: int = 2) -> DataFrame:
    """Classes with fewer than `below` train rows, those seen in test only included."""
    trained = F.sum(F.when(~F.col(is_test), 1).otherwise(0)).alias("train_rows")
    tested = F.sum(F.when(F.col(is_test), 1).otherwise(0)).alias("test_rows")
    return df.groupBy(label).agg(trained, tested).where(F.col("train_rows") < below)


def singleton_classes(df: DataFrame, label: str, is_test: str) -> DataFrame:
    """Classes with exactly one train row."""
    return sparse_classes(df, label, is_test).where("train_rows = 1").select(label, "train_rows")


def only_test_classes(df: DataFrame, label: str, is_test: str) -> DataFrame:
    """Classes of test rows that no train row has."""
    test = df.where(F.col(is_test)).select(label).distinct()
    train = df.where(~F.col(is_test)).select(label).distinct()
    return test.join(train, label, "left_anti")


# --- columns and keys ------------------------------------------------------------------


def fill_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of non-empty texts, one column each, in one pass."""
    return df.agg(*[F.avg((empty_text(c) != "").cast("int")).alias(c) for c in cols])


def require_fill(df: DataFrame, cols: Sequence[str], min_rate: float = 0.05) -> None:
    rates = fill_rate(df, cols).first().asDict()
    low = {c: r for c, r in rates.items() if (r or 0.0) < min_rate}
    if low:
        raise ValueError(f"text columns filled below {min_rate:.0%}: {low}")


def prevalence(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of rows with each 0/1 flag set."""
    return df.agg(*[F.avg(c).alias(c) for c in flags])


def key_dupes(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of their key."""
    sizes = df.groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


# --- time ranges -----------------------------------------------------------------------


def trim_history(df: DataFrame, ts: str, hours: float) -> DataFrame:
    """Rows of the last `hours` before the newest row. The bound is a literal, so it reaches the scan."""
    newest = df.agg(F.max(ts)).first()[0]
    return df if newest is None else df.where(F.col(ts) >= F.lit(newest - dt.timedelta(hours=hours)))


def after_warmup(df: DataFrame, ts: str, hours: float, first: dt.datetime | None = None) -> DataFrame:
    """Rows at least `hours` after the first one."""
    first = first or df.agg(F.min(ts)).first()[0]
    return df.where(F.lit(False)) if first is None else df.where(F.col(ts) >= F.lit(first + dt.timedelta(hours=hours)))

