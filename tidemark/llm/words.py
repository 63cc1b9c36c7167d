"""Words and five-word windows as column expressions.

A word is a run of characters other than space and the controls 9 to 13. Null text has no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACES = r"[\x20\x09-\x0D]+"
WINDOW_WORDS = 5


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES, -1), lambda w: w != "")


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """Give every row a number of its own. The numbers hold once the result is written; write it before using them."""
    return df.withColumn(name, F.monotonically_increasing_id())


def add_word_hashes(df: DataFrame, words_col: str, out: str) -> DataFrame:
    return df.withColumn(out, F.transform(words_col, lambda w: F.xxhash64(w)))


def window_hashes(hashes_col: str, offsets: tuple[int, ...] = tuple(range(WINDOW_WORDS))) -> Column:
    """One 64-bit hash for each five-word window, in text order, over its words at `offsets`; empty for shorter texts.

    `hashes_col` must be a column of its own projection: the expression reads it once per word.
    """

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(hashes_col), i + k) for k in offsets])

    count = F.size(hashes_col) - (WINDOW_WORDS - 1)
    # sequence(0, -1) would count down, so short texts get the empty array instead.
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, window)
