"""Periodic runs of words, found by uniting suffix classes by decreasing common prefix.

A run is a stretch of words that repeats itself with a smallest period q, long enough and not extendable. Suffixes of a
text (from a word to its end) are sorted, and each pair of neighbours has a longest common prefix. Taking the pairs by
decreasing prefix, as Kruskal takes edges, a union-find joins the classes of suffixes that share so many words; each
class keeps its positions in order. Positions that become neighbours in a class have exactly the present prefix in
common; where their distance is within it, the text repeats there with that distance as period, for prefix plus distance
words. Such a seed is a run unless the word before continues the period, which is then found from an earlier position.

Runs asked for hold their period `copies` times, so only seeds with a prefix of `copies - 1` distances count. For these
the order of pairs with equal prefixes does not matter: a position that later came between the two would share with the
first a shorter period of the whole stretch, and would then have been united with it at a longer prefix. The distance of
a seed is therefore the smallest period.

Suffixes that share fewer words than any run needs are never sorted: identifiers of windows of growing width (1, 2, 4,
... words, each from a pair of the last ones) are made for a batch of texts at once, and only positions whose window
comes twice in the text go on.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import STEP, U64, find_words, mix, ranges, slices, spelled, utf8

LEAST_WORDS = 6
COPIES = 4
Run = tuple[int, int, int]  # start, length, period


def _pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Numbers of the pairs, in their order."""
    width = int(second.max(initial=0)) + 1
    return np.unique(first * width + second, return_inverse=True)[1]


def repeated_windows(words: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose window of `size` words comes twice in their text, and for each position the rank of its window.

    `words` are the word numbers of all texts, one behind the other. Ranks order windows by their text, then by their
    words; the end of a text is smaller than any word.
    """
    n = len(words)
    rank, have = words + 1, 1
    text_end = np.searchsorted(text, text, "right")

    def later(step: int) -> np.ndarray:
        at = np.arange(n) + step
        return np.where(at < text_end, rank[np.minimum(at, n - 1)], 0)

    while have < size:
        step = min(have, size - have)
        rank, have = _pairs(rank, later(step)) + 1, have + step
    rank = _pairs(text, rank)
    return np.flatnonzero(np.bincount(rank, minlength=1)[rank] > 1), rank


def sort_suffixes(active: np.ndarray, rank: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """`active` in the order of their suffixes; `rank` has the ranks of all windows of `size` words.

    A rank becomes the number of suffixes before its class, so that sorting a class leaves all other ranks as they are.
    """
    count = np.bincount(rank)
    rank = (np.cumsum(count) - count)[rank]
    text_end = np.searchsorted(text, text, "right")
    todo = active
    while len(todo):
        at = todo + size
        behind = np.where(at < text_end[todo], rank[np.minimum(at, len(rank) - 1)] + 1, 0)
        order = np.lexsort((behind, rank[todo]))
        todo, behind, own = todo[order], behind[order], rank[todo][order]
        head = np.ones(len(todo), bool)
        head[1:] = own[1:] != own[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(todo)), 0))
        head[1:] |= behind[1:] != behind[:-1]
        finer = np.maximum.accumulate(np.where(head, np.arange(len(todo)), 0))
        rank[todo] = own + finer - first
        many = np.bincount(np.cumsum(head) - 1, minlength=1)[np.cumsum(head) - 1] > 1
        todo, size = todo[many], 2 * size
    return active[np.argsort(rank[active], kind="stable")]


def common_prefixes(words: list[int], suffixes: list[int], size: int) -> list[int]:
    """Common prefix, in words, of each of these sorted suffixes with the one before it.

    Going through positions from left to right, a prefix is at most one word shorter than that of the position before,
    as long as it holds the `size` words by which suffixes are chosen: then the other position's next one is there too.
    """
    place = {p: k for k, p in enumerate(suffixes)}
    out, n, have, last = [0] * len(suffixes), len(words), 0, -2
    for p in sorted(suffixes):
        have = have - 1 if p == last + 1 and have > size else 0
        last, k = p, place[p]
        if not k:
            have = 0
            continue
        other = suffixes[k - 1]
        most = n - max(p, other)
        while have < most and words[p + have] == words[other + have]:
            have += 1
        out[k] = have
    return out


def runs(words: list[int], suffixes: list[int], least: int = LEAST_WORDS, copies: int = COPIES) -> list[Run]:
    """Runs of one text by start and period. `suffixes`: in order, at least all positions whose first words, as many as
    `least_prefix` says, come again in the text."""
    need = least_prefix(least, copies)
    prefix = common_prefixes(words, suffixes, need)
    parent = list(range(len(suffixes)))
    members = [[p] for p in suffixes]
    found: list[Run] = []

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    def seed(p: int, q: int, shared: int) -> None:
        period = q - p
        length = shared + period
        if length >= least and length >= copies * period and (not p or words[p - 1] != words[q - 1]):
            found.append((p, length, period))

    for k in sorted((k for k in range(1, len(suffixes)) if prefix[k] >= need), key=lambda k: -prefix[k]):
        shared, a, b = prefix[k], root(k - 1), root(k)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small, before = members[a], members[b], -1
        for p, behind in zip(small, [*small[1:], len(words)], strict=True):
            # Positions of one class have been neighbours already, or have others of their class between them.
            at = bisect_left(large, p)
            if at and large[at - 1] != before:
                seed(large[at - 1], p, shared)
            if at < len(large) and large[at] < behind:
                seed(p, large[at], shared)
            large.insert(at, p)
            before = p
        parent[b], members[b] = a, []
    return sorted((p, length, period) for p, length, period in found)


def least_prefix(least: int = LEAST_WORDS, copies: int = COPIES) -> int:
    """The smallest common prefix that a run's first position has with the next copy: length less period."""
    return min(max(least - q, (copies - 1) * q) for q in range(1, least + 1))


def _may_repeat(words: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """For each word whether its text may hold a window of `size` words twice; equal hashes say so, others never."""
    last = max(len(words) - size + 1, 0)
    value = text[:last].astype(U64)
    for k in range(size):
        value = mix(value * STEP + words[k : k + last].astype(U64))
    value, owner = value[text[:last] == text[size - 1 :][:last]], text[:last][text[:last] == text[size - 1 :][:last]]
    order = np.argsort(value, kind="stable")
    twice = np.flatnonzero(value[order][1:] == value[order][:-1])
    return np.isin(text, owner[order[twice]])


def batch_runs(words: np.ndarray, text: np.ndarray, count: int, least: int = LEAST_WORDS, copies: int = COPIES) -> list[list[Run]]:
    """Runs of each of `count` texts; `words` numbers their words, one text behind the other, `text` says whose they are."""
    out: list[list[Run]] = [[] for _ in range(count)]
    size = least_prefix(least, copies)
    some = _may_repeat(words, text, size)
    words, text = words[some], text[some]
    if not len(words):
        return out
    active, rank = repeated_windows(words, text, size)
    order = sort_suffixes(active, rank, text, size)
    owner, first = np.unique(text[order], return_index=True)
    begin, end = np.searchsorted(text, owner, "left"), np.searchsorted(text, owner, "right")
    for t, group, a, b in zip(owner.tolist(), np.split(order, first[1:]), begin.tolist(), end.tolist(), strict=True):
        out[t] = runs(words[a:b].tolist(), (group - a).tolist(), least, copies)
    return out


def _joined(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, count: int) -> pa.Array:
    """Texts of the given words, joined by one space."""
    sizes = end - start + 1
    spaced = np.append(data, np.uint8(0))[ranges(start, sizes)]
    spaced[np.cumsum(sizes) - 1] = 0x20
    some = np.bincount(text, minlength=count) > 0
    length = np.bincount(text, weights=sizes, minlength=count).astype(np.int64) - some
    last = np.zeros(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    last[-1:] = True
    letters = np.delete(spaced, (np.cumsum(sizes) - 1)[last])
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return whole.cast(pa.large_string()).cast(pa.string())


Change = Callable[[int | None, int], np.ndarray | None]


def _work(batches: Iterator[pa.RecordBatch], change: Change | None, least: int, copies: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "runs", "collapsed"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for part in slices(batches, "text"):
        data, at = utf8(part.column("text"))
        start, end, text = find_words(data, at)
        n = np.bincount(text, minlength=part.num_rows)
        source, begin = np.arange(len(text)), np.cumsum(n) - n
        if change is not None:
            for t, doc_id in enumerate(part.column("doc_id").to_pylist()):
                order = change(doc_id, int(n[t]))
                if order is not None:
                    source[begin[t] : begin[t] + n[t]] = begin[t] + order
        found = batch_runs(spelled(data, start, end)[0][source], text, part.num_rows, least, copies)
        keep = np.ones(len(text), bool)
        for t, own in enumerate(found):
            for first, length, period in own:
                keep[begin[t] + first + period : begin[t] + first + length] = False
        lists = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in found], kind)
        clean = _joined(data, start[source[keep]], end[source[keep]], text[keep], part.num_rows)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), lists, clean], names)


def find_runs(docs: DataFrame, change: Change | None = None, least: int = LEAST_WORDS, copies: int = COPIES) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words) and collapsed for every row of `docs` (doc_id, text).

    A run has at least `least` words and `copies` periods, and no longer stretch around it has its period. `collapsed`
    is the text without the words that a run holds behind its first period, the others joined by one space. `change`
    may put other words of the same text in place first: it gets id and number of words, and gives word numbers or None. Each row is looked at alone, so nothing is shuffled, and repeated rows and null
    ids are rows like any other. Null and empty texts have no words, no runs and an empty `collapsed`. A text is worked
    on whole, however long, by one task, in memory of about 150 bytes for each of its words and 400 for each word that
    repeats. Other columns are not looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(partial(_work, change=change, least=least, copies=copies), schema)


def made_periodic(doc_id: int | None, n: int) -> np.ndarray | None:
    """For every tenth id, by its CRC-32: the words of its text repeat from some word on. Other texts, null ids too, stay."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % (1 + (n - a) // (3 + g % 8)))


def summarise(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """One row per row of `docs`: its number of runs, the one repeated most often (greatest length / period; ties:
    smallest start, then period; nulls without a run), and digests of all runs and of the collapsed text."""
    found = find_runs(docs, change)
    # Lengths and periods are below 2^31, so ratios that differ do so by more than doubles round; cross products decide.
    ahead = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    best = F.reduce("runs", F.get("runs", 0), lambda a, r: F.when(ahead(r, a) > 0, r).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
