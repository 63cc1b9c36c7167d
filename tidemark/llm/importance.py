"""Importance resampling towards a target distribution, with weights summed over bit planes.

Features of a text are its runs of one and two words, hashed into a fixed number of buckets. All raw texts and all target
texts give one count per bucket, and the smoothed log ratio of the two, in whole thousandths, is the bucket's gain. The
weight of a text is the floored mean of the gains over its features.

That sum is taken over bit planes. Plane i of a text has one bit per bucket, set where bit i of the text's count in that
bucket is; plane j of the gains has bit j of each gain in two's complement. A plane of one, AND a plane of the other,
leaves the buckets that add 2^(i+j) to the sum, and a population count says how many there are; the highest gain plane
counts negative. All numbers are whole, so sums are exact and do not depend on order or partitioning.

The draw adds Gumbel noise from a hash of the id to each weight and takes the highest scores: a weighted sample without
replacement that is the same in every run.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrays import find_words, lower_ascii, slices, spelled, utf8
from tidemark.operators.skew import group_rank
from tidemark.session import stored

BUCKETS = 10_000
SCALE = 1000  # gains, weights and scores are whole thousandths
MIN_WORDS = 20  # shorter texts are not drawn
PERCENT = 25
SEED = 7

# Bytes between words, once A-Z are lower case: all ASCII but digits and letters.
OUTSIDE = np.ones(256, bool)
OUTSIDE[0x30:0x3A] = OUTSIDE[0x61:0x7B] = OUTSIDE[0x80:] = False


@lru_cache(maxsize=40)
def _zeros(doublings: int) -> np.ndarray:
    """What 2**doublings further zero bytes make of a CRC-32 register: a table of 256 values for each of its bytes."""
    if doublings:
        half = _zeros(doublings - 1)
        return _through(half, half)
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = np.where(single & 1, (single >> 1) ^ np.uint32(0xEDB88320), single >> 1)
    register = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return single[register & 255] ^ (register >> 8)


def _through(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]


def joined_crc(left: np.ndarray, right: np.ndarray, right_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings put together, from the CRC-32 of each and the length of the second."""
    out = left.astype(np.uint32)
    for k in range(int(right_bytes.max()).bit_length() if len(right_bytes) else 0):
        here = (right_bytes >> k) & 1 == 1
        out[here] = _through(_zeros(k), out[here])
    return out ^ right


def features(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and bucket of every feature of a batch of texts, and the number of words of each text."""
    data, at = utf8(texts)
    data = lower_ascii(data)
    start, end, text = find_words(data, at, OUTSIDE)
    code, words = spelled(data, start, end)
    plain = words.to_pylist()
    alone = np.fromiter((zlib.crc32(w) for w in plain), np.uint32, len(plain))[code]
    behind = np.fromiter((zlib.crc32(b" " + w) for w in plain), np.uint32, len(plain))[code]
    pair = np.flatnonzero(text[1:] == text[:-1])
    both = joined_crc(alone[pair], behind[pair + 1], (end - start)[pair + 1] + 1)
    return np.concatenate([text, text[pair]]), np.concatenate([alone, both]).astype(np.int64) % buckets, np.bincount(text, minlength=len(texts))


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Rows (bucket, n) for the buckets that features of `docs` fall into; each task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in slices(batches, "text"):
            total += np.bincount(features(part.column("text"), buckets)[1], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    texts = docs.select(F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Gain of each bucket; the two sets of counts that meet on the driver have `buckets` rows each at most."""
    raw, wanted = ({r.bucket: r.n for r in bucket_counts(df, text, buckets).collect()} for df in (docs, target))
    all_raw, all_wanted = sum(raw.values()) + buckets, sum(wanted.values()) + buckets
    ratio = (((wanted.get(b, 0) + 1) * all_raw) / ((raw.get(b, 0) + 1) * all_wanted) for b in range(buckets))
    return [math.floor(SCALE * math.log(x)) for x in ratio]


class GainPlanes:
    """Gains as bit planes, and the exact sums of counts times gains."""

    def __init__(self, gains: list[int]) -> None:
        self.buckets = len(gains)
        self.words = -(-self.buckets // 64)
        value = np.array(gains, np.int64)
        bits = int(np.abs(value).max(initial=0)).bit_length() + 1  # the highest one is the sign
        planes = np.zeros((bits, self.words * 64), bool)
        planes[:, : self.buckets] = (value >> np.arange(bits)[:, None]) & 1
        self.planes = np.packbits(planes, axis=1, bitorder="little").view(np.uint64)
        self.scale = [1 << j for j in range(bits - 1)] + [-(1 << (bits - 1))]

    def sums(self, text: np.ndarray, bucket: np.ndarray, count: int) -> np.ndarray:
        """Sum of gains over the features (text, bucket) of each of `count` texts."""
        cell, n = np.unique(text * self.buckets + bucket, return_counts=True)
        text, bucket = np.divmod(cell, self.buckets)
        byte, bit = text * (8 * self.words) + (bucket >> 3), np.left_shift(1, bucket & 7)
        out = np.zeros(count, np.int64)
        for i in range(int(n.max(initial=0)).bit_length()):
            has = (n >> i) & 1 == 1
            plane = np.bincount(byte[has], weights=bit[has], minlength=count * 8 * self.words)
            plane = plane.astype(np.uint8).view(np.uint64).reshape(count, self.words)
            for own, scale in zip(self.planes, self.scale, strict=True):
                out += (scale << i) * np.bitwise_count(plane & own).sum(axis=1, dtype=np.int64)
        return out


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in whole thousandths, from a hash of seed and id; a null id counts as an empty one."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8)
    unit = (F.conv(head, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-SCALE * F.log(-F.log(unit))).cast("long")


def weigh(rows: DataFrame, gains: list[int]) -> DataFrame:
    """Rows (row, doc_id, text) to (row, doc_id, n_words, n_features, weight)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(gains)
        for part in slices(batches, "text"):
            text, bucket, n_words = features(part.column("text"), len(gains))
            n = np.bincount(text, minlength=part.num_rows)
            weight = planes.sums(text, bucket, part.num_rows) // np.maximum(n, 1)
            columns = [part.column("row"), part.column("doc_id"), *map(pa.array, (n_words, n, weight))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(work, "row long, doc_id long, n_words long, n_features long, weight long")


def _ranked(rows: DataFrame, percent: int, min_words: int) -> DataFrame:
    """Rows with `score` and, for the drawn ones, `rank`.

    Scores are counted first. A score is a weight (each gain is the logarithm of a ratio of counts, so below 90,000
    thousandths) plus noise (-3,200 to 22,900 thousandths): there are no more than 210,000 different ones, however many rows there are.
    Only rows with a score that reaches the draw are put in order, each score by itself.
    """
    spark = rows.sparkSession
    counts = rows.where(F.col("n_words") >= min_words).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    take, before, places = percent * sum(r.n for r in counts) // 100, 0, []
    for r in sorted(counts, key=lambda r: -r.score):
        if before >= take:
            break
        places.append((r.score, before))
        before += r.n
    if not places:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    able = (F.col("n_words") >= min_words) & (F.col("score") >= places[-1][0])
    chosen = rows.where(able).withColumn("unnamed", F.col("doc_id").isNull())
    chosen = group_rank(chosen, ["score"], ["unnamed", "doc_id", "row"], "place")
    chosen = chosen.join(F.broadcast(spark.createDataFrame(places, "score long, before long")), "score")
    rank = F.col("before") + F.col("place") + 1
    chosen = chosen.withColumn("rank", F.when(rank <= take, rank).cast("long"))
    return chosen.select(*rows.columns, "rank").union(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))


def _resampled(rows: DataFrame, target: DataFrame, percent: int, min_words: int, seed: int) -> DataFrame:
    weighed = weigh(rows, gains(rows, target)).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    return _ranked(stored(weighed, "weights"), percent, min_words)


def _columns(docs: DataFrame) -> list[Column]:
    return [F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank for every row of `docs` (doc_id, text).

    `target` (text) holds the texts to resemble. Of the rows with `min_words` words or more, `percent` per cent (rounded
    down) with the highest scores are drawn and ranked from 1; rank is null for the others. Ties go to the smaller
    doc_id, null ids last, and among repeated rows to any one. Null and empty texts have no features and weight 0. An
    empty target gives gains from raw counts alone; empty `docs` give no rows. A text of any length is counted as a
    whole, in one task, which needs about 60 bytes of memory for each of its own. Other columns are not looked at.
    """
    out = _resampled(docs.select(*_columns(docs)), target, percent, min_words, seed)
    return out.select("doc_id", "n_words", "n_features", "weight", "score", "rank")


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of `docs` with all their columns, as they are; see `resample` for the draw."""
    whole = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own"), *_columns(docs)), "rows")
    ranks = _resampled(whole.select("row", "doc_id", "text"), target, percent, min_words, seed)
    drawn = ranks.where("rank is not null").select("row")
    return whole.join(drawn, "row", "left_semi").select("own.*")
