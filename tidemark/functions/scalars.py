"""Column expressions used by the feature and scoring plans."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions.parse import _col, micros

DAY_MICROS = 86_400_000_000


def presence(col: Column | str) -> Column:
    return _col(col).isNotNull().cast("int")


def yes_flag(col: Column | str) -> Column:
    return (F.lower(F.coalesce(_col(col), F.lit(""))) == "yes").cast("int")


def lag_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days between two timestamps, rounded towards minus infinity."""
    gap = micros(later) - micros(earlier)
    return ((gap - F.pmod(gap, F.lit(DAY_MICROS))) / DAY_MICROS).cast("int")


def text_length(col: Column | str) -> Column:
    """Length in code points; a missing text has length 0."""
    return F.char_length(F.coalesce(_col(col), F.lit("")))


def strip_prefix(col: Column | str, prefix: str) -> Column:
    """Remove every literal occurrence of `prefix`."""
    return F.replace(_col(col), F.lit(prefix), F.lit(""))


def safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.try_divide(a, b)).otherwise(F.lit(0.0))


def f1_score(precision: Column, recall: Column) -> Column:
    return safe_div(2 * precision * recall, precision + recall)


def f1_band(f1: Column) -> Column:
    return F.when(f1 < 0.3, "low").when(f1 < 0.6, "middle").otherwise("high")


def correct_flag(predicted: Column, actual: Column) -> Column:
    """True or false where the actual label is known, else null."""
    return F.when(actual.isNotNull(), predicted.eqNullSafe(actual))


def best_of(probabilities: Column, labels: Column) -> tuple[Column, Column]:
    """(label, confidence) of the largest probability; the first one wins a tie."""
    top = F.array_max(probabilities)
    return F.get(labels, F.array_position(probabilities, top).cast("int") - 1), top


def probability_names(labels: Sequence[str], width: int = 24) -> list[str]:
    """One distinct column name per label, also where long labels share a beginning."""
    seen: Counter[str] = Counter()
    names = []
    for label in labels:
        base = f"prob_{label[:width]}"
        names.append(f"{base}_{seen[base] - 1:04d}" if seen[base] else base)
        seen[base] += 1
    return names


def row_key(uuid: Column | None, content: Sequence[Column]) -> Column:
    """Row key: the given id as text, else a digest of file, position and content.

    The digest is the same after a retry, which a generated sequence is not.
    """
    if uuid is not None:
        return uuid.cast("string")
    parts = [F.coalesce(c.cast("string"), F.lit("\u0000")) for c in content]
    return F.sha2(F.concat_ws("\u0001", *parts), 256)
