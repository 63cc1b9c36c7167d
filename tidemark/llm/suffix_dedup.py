"""Removing long strings that occur again, by bucket refinement over suffix starts.

Every start position belongs to an initial bucket and is refined by bucket identifiers of later offsets, as in
bucket-pointer refinement: the identifier of the 2k bytes at i is made from those of the k bytes at i and at i + k, and
each level reuses the one below, up to the 200 bytes that decide. Identifiers are made from content, so buckets can be
refined in any task without a global sort, and equal strings meet by identifier.

* Initial buckets: a position's bucket is the smallest identifier among the 32-byte strings inside its 200 bytes. Equal
  200-byte strings have equal buckets. Neighbouring positions mostly share one, so a text is a list of runs, about one
  for 85 bytes. A bucket with a single run and a single place of its 32 bytes holds no repeat and is dropped.
* First refinement: runs of one bucket that agree in all their bytes are settled as a whole: all positions repeat.
* Second refinement: runs left alone by that, with one run of each settled group beside them, are cut into blocks of
  starts by their distance to the first place of the 32 bytes at or behind the start. Equal 200-byte strings have equal
  distances, whatever follows them. Blocks that agree in all their bytes are settled as a whole; a
  repeat needs the bytes that all starts of its block share, so blocks that share them with no other are dropped.
* Last refinement: the starts that remain are grouped by (bucket, identifier of the 200 bytes), 128 bits in all.

Equal texts are settled before all that: texts of 200 bytes or more with a copy are removed whole, and one of the copies
takes part so that others find its strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import BYTE_CODE, STEP, U64, mix, ranges, slices, utf8
from tidemark.llm.texts import fetch_texts
from tidemark.session import stored

LENGTH, FIRST = 200, 32
WINDOW = LENGTH - FIRST + 1
BLOCK = 24  # starts in one block
PIECE = 2 << 20  # bytes worked on at once


def _names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of the 32 and of the 128 bytes at each start that has as many bytes behind it."""

    def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x = a * STEP + b * U64(0xD6E8FEB86659FD93)
        return x ^ (x >> U64(31))

    level, size = BYTE_CODE[data], 1
    first = level
    while size < 128:
        level, size = joined(level[:-size], level[size:]), 2 * size
        if size == FIRST:
            first = level
    return first, level


def _longer(half: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Identifiers of 128 to 256 bytes at the given starts, from those of 128 bytes."""
    x = half[start] * STEP + half[start + length - 128] * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(31))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over x[i : i + width] for each i with a whole window."""
    blocks = -(-len(x) // width)
    fill = np.iinfo(U64).max if best is np.minimum else 0
    square = np.full(blocks * width, fill, U64)
    square[: len(x)] = x
    square = square.reshape(blocks, width)
    ahead = best.accumulate(square, axis=1).ravel()
    back = best.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(x) - width + 1
    return best(back[:count], ahead[width - 1 : width - 1 + count])


def _pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Texts of about PIECE bytes together: bytes, offsets, number of the first text, place of the piece in it.

    A longer text comes in pieces that overlap so that every start is in exactly one piece with all its bytes.
    """
    first = 0
    while first < len(at) - 1:
        if at[first + 1] - at[first] > 2 * PIECE:
            for begin in range(0, int(at[first + 1] - at[first]), PIECE):
                part = data[at[first] + begin : min(at[first] + begin + PIECE + LENGTH - 1, at[first + 1])]
                yield part, np.array([0, len(part)]), first, begin
            first += 1
            continue
        stop = max(first + 1, int(np.searchsorted(at, at[first] + PIECE, "right")) - 1)
        long = np.flatnonzero(np.diff(at[first : stop + 1]) > 2 * PIECE)
        stop = first + int(long[0]) if len(long) else stop
        yield data[at[first] : at[stop]], at[first : stop + 1] - at[first], first, 0
        first = stop


def _starts(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts that have LENGTH bytes of their own text, and the text of each."""
    room = np.maximum(np.diff(at) - LENGTH + 1, 0)
    text = np.repeat(np.arange(len(room)), room)
    return np.arange(len(text)) - np.repeat(np.cumsum(room) - room, room) + at[:-1][text], text


def _runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts with one bucket.

    Text, start in the text, length, bucket, identifier of all bytes, several places, place in the text.
    """
    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),) * 2 + (np.zeros(0, bool), np.zeros(0, np.int64))
    first, half = _names(data)
    name = _longer(half, np.arange(len(data) - LENGTH + 1), LENGTH)
    low = _sliding(first, WINDOW, np.minimum)
    start, text = _starts(at)
    valid = np.zeros(len(low), bool)
    valid[start] = True
    low[~valid] = 0
    # A 32-byte string is a place of its bucket if it is the smallest of some 200 bytes around it.
    high = _sliding(np.concatenate([np.zeros(WINDOW - 1, U64), low, np.zeros(WINDOW - 1, U64)]), WINDOW, np.maximum)
    place = np.flatnonzero((high == first) & (high > 0))
    own = np.searchsorted(at, place, "right") - 1
    order = np.lexsort((first[place], own))
    of, value = own[order], first[place][order]
    twice = (of[1:] == of[:-1]) & (value[1:] == value[:-1])
    several = set(zip(of[1:][twice].tolist(), value[1:][twice].tolist(), strict=True))

    bucket = low[start]
    head = np.ones(len(start), bool)
    head[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(head)
    length = np.diff(np.append(begin, len(start)))
    step = np.arange(len(start)) - np.repeat(begin, length)
    whole = np.add.reduceat(mix(name[start] + step.astype(U64) * STEP), begin) if len(begin) else np.zeros(0, U64)
    more = np.zeros(len(begin), bool)
    if several:
        more = np.fromiter(((t, b) in several for t, b in zip(text[begin].tolist(), bucket[begin].tolist(), strict=True)), bool, len(begin))
    # The first place of its bucket at or behind the last start of a run.
    which = np.searchsorted(place, start[begin] + length - 1)
    while (other := first[place[which]] != bucket[begin]).any():
        which = which + other
    return text[begin], (start - at[:-1][text])[begin], length, bucket[begin], whole, more, place[which] - at[:-1][text[begin]]


INDEX = "row long, doc_id long, digest binary, n_bytes long, runs array<struct<start:long,length:long,bucket:long,whole:long,several:boolean,place:long>>"


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", limit=2 * PIECE):
        data, at = utf8(part.column("text"))
        found = []
        for piece, offsets, first, begin in _pieces(data, at):
            text, start, length, bucket, whole, several, place = _runs(piece, offsets)
            found.append((text + first, start + begin, length, bucket.view(np.int64), whole.view(np.int64), several, place + begin))
        columns = [np.concatenate([f[k] for f in found]) for k in range(7)]
        count = np.bincount(columns[0], minlength=part.num_rows)
        struct = pa.StructArray.from_arrays([pa.array(c) for c in columns[1:]], ["start", "length", "bucket", "whole", "several", "place"])
        runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), struct)
        whole = data.tobytes()
        digests = [hashlib.sha256(whole[a:b]).digest() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("doc_id"), pa.array(digests, pa.binary()), pa.array(np.diff(at)), runs],
            ["row", "doc_id", "digest", "n_bytes", "runs"],
        )


def _located(part: pa.RecordBatch, fields: tuple[str, ...]) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], np.ndarray, dict[str, np.ndarray]]]:
    """For each piece of the texts: identifiers of 32 and of 128 bytes, node of each run that starts in it, and the runs' fields.

    `at` is added to the fields: where the text begins in the piece (before it, for a later piece of a long text).
    """
    data, at = utf8(part.column("text"))
    nodes = part.column("node").to_numpy(zero_copy_only=False)
    runs = part.column("runs")
    count = np.diff(runs.offsets.to_numpy()) if len(runs) else np.zeros(0, int)
    flat = runs.flatten()
    values = {k: flat.field(k).to_numpy(zero_copy_only=False) for k in fields}
    owner = np.repeat(np.arange(len(nodes)), count)
    for piece, offsets, first, begin in _pieces(data, at):
        if len(piece) < LENGTH:
            continue
        here = (owner >= first) & (owner < first + len(offsets) - 1) & (values["start"] >= begin)
        if len(offsets) == 2:  # maybe part of a longer text
            here &= values["start"] < begin + len(piece) - LENGTH + 1
        mine = owner[here]
        yield _names(piece), nodes[mine], {k: v[here] for k, v in values.items()} | {"at": offsets[mine - first] - begin}


BLOCKS = "node long, bucket long, number long, low long, high long, place long, core long, whole long, alone boolean"


def _parted(first: np.ndarray, run: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs cut behind every place in them: number of the run, first start, last start, place.

    The place of a part is the first one at or behind each of its starts.
    """
    last = run["start"] + run["length"] - 1
    many = np.flatnonzero(run["several"])
    start, of = ranges(run["start"][many], run["length"][many]), np.repeat(many, run["length"][many])
    inside = (first[start + run["at"][of]] == run["bucket"].view(U64)[of]) & (start < last[of])
    of = np.concatenate([of[inside], np.arange(len(last))])
    stop, place = np.concatenate([start[inside], last]), np.concatenate([start[inside], run["place"]])
    order = np.lexsort((stop, of))
    of, stop, place = of[order], stop[order], place[order]
    begin = run["start"][of]
    later = np.flatnonzero(of[1:] == of[:-1]) + 1
    begin[later] = stop[later - 1] + 1
    return of, begin, stop, place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the runs: starts whose distance to the first place at or behind them is low to high."""
    for part in slices(batches, "text", limit=2 * PIECE):
        for (first, half), node, run in _located(part, ("start", "length", "bucket", "alone", "several", "place")):
            whose, begin, stop, at = _parted(first, run)
            least, most = at - stop, at - begin
            count = most // BLOCK - least // BLOCK + 1
            part_of = np.repeat(np.arange(len(whose)), count)
            number = ranges(least // BLOCK, count)
            low, high = np.maximum(least[part_of], number * BLOCK), np.minimum(most[part_of], number * BLOCK + BLOCK - 1)
            of, at = whose[part_of], at[part_of]
            place = run["at"][of] + at
            nearest, farthest = number * BLOCK, np.minimum(number * BLOCK + BLOCK - 1, WINDOW - 1)
            core = _longer(half, place - nearest, LENGTH - (farthest - nearest))
            whole = _longer(half, place - high, LENGTH + high - low)
            columns = [node[of], run["bucket"][of], number, low, high, at, core.view(np.int64), whole.view(np.int64), run["alone"][of]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in BLOCKS.split(", ")])


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single starts of the given stretches of each text, as (node, bucket, name, start, alone)."""
    for part in slices(batches, "text", limit=2 * PIECE):
        for (_, half), node, run in _located(part, ("start", "length", "bucket", "alone")):
            of = np.repeat(np.arange(len(node)), run["length"])
            start = run["start"][of] + np.arange(len(of)) - np.repeat(np.cumsum(run["length"]) - run["length"], run["length"])
            name = _longer(half, start + run["at"][of], LENGTH).view(np.int64)
            columns = [node[of], run["bucket"][of], name, start, run["alone"][of]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "bucket", "name", "start", "alone"])


def merged(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, stop) of the union of intervals."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate((start + length)[order])
    head = np.ones(len(start), bool)
    head[1:] = start[1:] > reach[:-1]
    begin = np.flatnonzero(head)
    return start[begin], reach[np.append(begin[1:], len(start)) - 1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        rows = []
        for node, text, starts, lengths in zip(*(part.column(c).to_pylist() for c in ("node", "text", "starts", "lengths")), strict=True):
            raw = text.encode()
            begin, stop = merged(np.array(starts), np.array(lengths))
            left = hashlib.sha256()
            for a, b in zip([0, *stop.tolist()], [*begin.tolist(), len(raw)], strict=True):
                left.update(raw[a:b])
            rows.append((node, int((stop - begin).sum()), len(begin), left.hexdigest(), begin.tolist(), stop.tolist()))
        names = ["node", "n_removed", "n_spans", "kept_sha256", "begins", "stops"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def repeated(docs: DataFrame) -> DataFrame:
    """What to remove from every row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256, begins, stops.

    A byte goes if a 200-byte string over it also starts anywhere else, in the same text too; null texts are empty, and
    matches never cross texts. begins and stops are the maximal removed byte ranges. Repeated rows are copies: with 200
    bytes or more they lose all. Null ids are kept as they are. Other columns are not looked at.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = stored(rows.mapInArrow(_index, INDEX), "suffix-runs")
    texts = index.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), (F.count(F.lit(1)) > 1).alias("copied"))
    texts = stored(texts, "texts")
    own = texts.select(F.col("node").alias("row"), "copied")
    runs = index.select("row", F.explode_outer("runs").alias("run")).where("run is not null").join(own, "row")
    runs = runs.select(F.col("row").alias("node"), "copied", "run.*")

    buckets = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("several").alias("s")).where("n > 1 or s").select("bucket")
    open_runs = stored(runs.join(buckets, "bucket"), "bucket-runs")
    same = ["bucket", "whole", "length"]
    groups = stored(
        open_runs.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.max("copied").alias("copied"), F.min(F.struct("node", "start", "place", "several")).alias("one")),
        "run-groups",
    )
    alone = groups.where("n = 1 and not copied").select("bucket").distinct()
    chosen = groups.join(alone, "bucket", "left_semi").select("bucket", "length", "one.*", ((F.col("n") == 1) & ~F.col("copied")).alias("alone"))
    run = F.struct("start", "length", "bucket", "alone", "several", "place")
    lists = stored(chosen.groupBy("node").agg(F.collect_list(run).alias("runs")), "chosen-runs")  # runs of one text
    found = fetch_texts(docs, texts.join(lists.select("node"), "node").select("node", "digest", "least"))
    blocks = stored(found.join(lists, "node").mapInArrow(_blocks, BLOCKS), "blocks")
    equal = ["bucket", "low", "high", "whole"]
    kinds = blocks.groupBy(*equal, "number", "core").agg(
        F.count(F.lit(1)).alias("n"), F.max("alone").alias("any"), F.min(F.struct("node", "place", "alone")).alias("one")
    )
    kinds = stored(kinds.withColumn("open", F.col("any") & (F.col("n") == 1)), "block-groups")
    cores = kinds.groupBy("bucket", "number", "core").agg(F.count(F.lit(1)).alias("c"), F.max("open").alias("o")).where("c > 1 and o")
    opened = kinds.join(cores.select("bucket", "number", "core"), ["bucket", "number", "core"])
    stretch = F.struct(
        (F.col("one.place") - F.col("high")).alias("start"), (F.col("high") - F.col("low") + 1).alias("length"), "bucket", F.col("open").alias("alone")
    )
    lists = stored(opened.groupBy("one.node").agg(F.collect_list(stretch).alias("runs")), "open-blocks")  # blocks of one text
    places = stored(found.join(lists, "node").mapInArrow(_open, "node long, bucket long, name long, start long, alone boolean"), "open-places")
    names = places.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n"), F.max("alone").alias("a")).where("n > 1 and a").select("bucket", "name")
    single = places.where("alone").join(names, ["bucket", "name"]).select("node", "start", F.lit(LENGTH).cast("long").alias("length"))
    alike = blocks.where("alone").join(kinds.where("n > 1").select(*equal), equal)
    alike = alike.select("node", (F.col("place") - F.col("high")).alias("start"), (F.col("high") - F.col("low") + LENGTH).alias("length"))

    settled = open_runs.where("not copied").join(groups.where("n > 1 or copied").select(*same), same)
    settled = settled.select("node", "start", (F.col("length") + (LENGTH - 1)).alias("length"))
    spans = single.union(alike).union(settled).groupBy("node").agg(F.collect_list("start").alias("starts"), F.collect_list("length").alias("lengths"))
    spans = stored(spans, "spans")  # spans of one text
    held = fetch_texts(docs, texts.join(spans.select("node"), "node").select("node", "digest", "least"))
    cut = held.join(spans, "node").mapInArrow(
        _cut, "node long, n_removed long, n_spans long, kept_sha256 string, begins array<long>, stops array<long>"
    )
    per_text = texts.select("digest", "node", "copied").join(cut, "node", "left").drop("node")
    out = index.select("doc_id", "digest", "n_bytes").join(stored(per_text, "cut-texts"), "digest")
    gone = F.col("copied") & (F.col("n_bytes") >= LENGTH)
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(gone, F.array(zero)).otherwise(F.coalesce("begins", none)).alias("begins"),
        F.when(gone, F.array("n_bytes")).otherwise(F.coalesce("stops", none)).alias("stops"),
    )
