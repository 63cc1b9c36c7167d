"""Quality classifier: regularised quadratic discriminant on transformed statistics of a text.

Each text gives counts and shares (of letters, marks, repeats, lines), transformed so that they are closer to normal:
logarithms of sizes, square roots of shares. Either class has a mean and a covariance. A covariance is shrunk towards
the pooled one, and that towards its diagonal, so both stay invertible with few rows or constant statistics. The score
is the logistic function of the difference of the two log densities plus the log prior ratio; Mahalanobis distances use
Cholesky factors that are inverted once.

Fitting needs sums only: per class the count, the sums and the sums of products, added up by Spark. What reaches the
driver has a size set by the number of statistics.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import SPACE, find_words, hash_spans, lower_ascii, multiset, shingles, slices, utf8
from tidemark.operators.skew import lookup
from tidemark.session import stored

TO_POOLED, TO_DIAGONAL, FLOOR = 0.3, 0.1, 1e-3


def _class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


UPPER, LOWER, DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class(bytes(range(48, 58)))
SYMBOL, STOP, SHOUT = _class(b"#*$%&|<>=@^~_{}[]\\/+"), _class(b".,;:?'\"()-"), _class(b"!")
STATISTICS = (
    "log_bytes log_words mean_word sd_word upper lower digit symbol stop shout wide space lines_per_word ends_symbol ends_stop "
    "marks_alone upper_words distinct_words commonest_word repeated_windows repeated_lines"
).split()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics for each text; null counts as empty, whose shares are 0."""
    data, at = utf8(texts)
    n = len(at) - 1
    size = np.diff(at)
    owner = np.repeat(np.arange(n), size)
    share = lambda table: np.bincount(owner[table[data]], minlength=n) / np.maximum(size, 1)
    start, end, text = find_words(data, at)
    length = (end - start).astype(float)
    words = np.bincount(text, minlength=n)
    per_word = lambda x: np.bincount(text, weights=x, minlength=n) / np.maximum(words, 1)
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length**2) - mean**2, 0))
    last, first = data[end - 1] if len(end) else data[:0], data[start] if len(start) else data[:0]
    of, _, count = multiset(text, hash_spans(lower_ascii(data), start, end))
    distinct = np.bincount(of, minlength=n) / np.maximum(words, 1)
    common = np.zeros(n)
    np.maximum.at(common, of, count)
    window, _, times = multiset(*shingles(texts))
    windows = np.bincount(window, weights=times, minlength=n)
    again = np.bincount(window, weights=times * (times > 1), minlength=n) / np.maximum(windows, 1)

    breaks = data == 10
    lines = np.bincount(owner[breaks], minlength=n) + (size > 0)
    head = np.zeros(len(data), bool)
    head[at[:-1][size > 0]] = True
    head[1:] |= breaks[:-1]
    begin = np.flatnonzero(head)
    stop = np.append(begin[1:], len(data))[: len(begin)]
    stop = stop - breaks[stop - 1]
    filled = stop > begin
    line_of, _, line_times = multiset(owner[begin][filled], hash_spans(data, begin[filled], stop[filled]))
    extra = np.bincount(line_of, weights=line_times - 1, minlength=n) / np.maximum(lines, 1)

    root = np.sqrt
    columns = [np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread)]
    columns += [root(share(t)) for t in (UPPER, LOWER, DIGIT, SYMBOL, STOP, SHOUT, _class(bytes(range(128, 256))), SPACE)]
    columns += [root(lines / np.maximum(words, 1)), root(per_word(SYMBOL[last] | SHOUT[last])), root(per_word(STOP[last]))]
    columns += [root(per_word((length == 1) & SYMBOL[first])), root(per_word(UPPER[first] & UPPER[last] & (length > 1)))]
    columns += [root(distinct), root(common / np.maximum(words, 1)), root(again), root(extra)]
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverted Cholesky factors and log determinants of both classes, on standardised statistics."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverses: np.ndarray
    offsets: np.ndarray  # log prior minus half the log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        logs = [o - 0.5 * (((z - m) @ inv.T) ** 2).sum(1) for m, inv, o in zip(self.means, self.inverses, self.offsets, strict=True)]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


@dataclass(frozen=True)
class Constant:
    """The only label seen, or no opinion."""

    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def from_sums(count: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant | Constant:
    """Model from the sums of both classes: count (2), sums (2, d), products (2, d, d)."""
    if not count.all():
        return Constant(0.5 if not count.any() else float(count[1] > 0))
    total = count.sum()
    means = sums / count[:, None]
    scatter = products - count[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), FLOOR**2))
    centre = sums.sum(0) / total
    unit = scale[:, None] * scale[None, :]
    pooled = pooled / unit
    target = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled))
    inverses, offsets = [], []
    for k in range(2):
        own = scatter[k] / count[k] / unit
        shrunk = (1 - TO_POOLED) * own + TO_POOLED * target + FLOOR * np.eye(len(scale))
        factor = np.linalg.cholesky(shrunk)
        inverses.append(np.linalg.inv(factor))
        offsets.append(np.log(count[k] / total) - np.log(np.diag(factor)).sum())
    return Discriminant(centre, scale, (means - centre) / scale, np.array(inverses), np.array(offsets))


def with_statistics(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, x) of `docs` (doc_id, text), written once."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x = statistics(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "x"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(work, f"doc_id {kind}, x array<double>"), "statistics")


def fit(labelled: DataFrame) -> Discriminant | Constant:
    """Fit on rows (x, label) with label 0 or 1; all rows are used."""
    d = len(STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, d + 1, d + 1))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            x = np.hstack([np.ones((len(x), 1)), x])
            label = batch.column("label").to_numpy(zero_copy_only=False)
            for k in range(2):
                total[k] += x[label == k].T @ x[label == k]
        place = np.arange(total.size)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total.ravel())], ["place", "value"])

    sums = labelled.select("x", "label").mapInArrow(add, "place long, value double").groupBy("place").agg(F.sum("value").alias("value"))
    total = np.zeros(2 * (d + 1) ** 2)
    for r in sums.collect():  # one number for each pair of statistics and class
        total[r["place"]] = r["value"]
    total = total.reshape(2, d + 1, d + 1)
    return from_sums(total[:, 0, 0], total[:, 0, 1:], total[:, 1:, 1:])


def held_out(doc_id: Column) -> Column:
    """A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs` (doc_id, text).

    Learns from rows that are not held out and have a label; a document with several labels counts as 1 if half of them
    or more are 1. Null labels and null ids teach nothing. Scores lie in 0 to 1. Without labels all scores are 0.5, with
    one class only they are that class. Null texts are empty, repeated rows are scored each, other columns are not
    looked at.
    """
    rows = with_statistics(docs).withColumn("held_out", held_out(F.col("doc_id")))
    marks = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    known = lookup(rows.where("not held_out"), marks, "doc_id", "inner", spread_by=("x",))
    model = fit(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(model.score(x))], ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", "held_out", "x").mapInArrow(work, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
