"""Near-duplicate documents: BagMinHash signatures, bands, and exact overlap of word-window multisets.

A text is the bag of its five-word windows with their counts as weights. For every window a Poisson process runs over
(weight, time); the weight axis is cut into the dyadic steps [0,1), [1,2), [2,4), ..., each with a process of its own
drawn from the window's hash. A document takes the points below its own weight: all points of the steps it fills, and
of the step it ends in those whose weight lies below its own. Points fall into `SLOTS` slots; a slot's value is the time
of its first point. Two bags agree in a slot with probability sum(min)/sum(max), their weighted Jaccard similarity.
Points are drawn in order of time and only up to a horizon by which all slots are filled (a larger one for the few
documents where one stays empty), so the work per document does not depend on its length.

Documents that agree in a band of slots are candidates. Texts of candidates are read once and become sets of numbered
windows (the second copy of a window is another element than the first), so that the overlap of two bags is the number
of elements two sets share; texts themselves are never sent to a comparison. All members of a band bucket are first
compared with one of them, the pivot, which is the one that meets the most others. A bucket is settled when its members
beside the pivot are all of one class. The others are compared within: a task gets a bucket (a large one in pairs of
blocks, dealt by the bytes of their sets) and reports one link for two classes, so that no candidate pair is left
undecided and no pairs are written out but linked ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.arrays import CHUNK_BYTES, STEP, U64, mix, multiset, ranges, release, shingles, slices
from tidemark.llm.components import components
from tidemark.llm.texts import digest, find_texts
from tidemark.operators.skew import is_small, lookup
from tidemark.session import stored

SIMILARITY = 0.8
ROWS, BANDS = 6, 42  # a pair at 0.8 shares no band once in 300,000 cases
SLOTS = ROWS * BANDS
SLACK = 3.0
BLOCK_BYTES = 4 << 20  # of sets, about, that one task holds beside as many others


def _unit(bits: np.ndarray) -> np.ndarray:
    return ((bits >> U64(11)).astype(np.float64) + 0.5) / (1 << 53)


def signatures(text: np.ndarray, value: np.ndarray, weight: np.ndarray, count: int, slots: int = SLOTS) -> np.ndarray:
    """Signature (count, slots) of `count` bags given as distinct (text, value) with whole weights; inf where empty."""
    total = np.bincount(text, weights=weight, minlength=count)
    out = np.full(count * slots, np.inf)
    horizon = (np.log(slots) + SLACK) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        picked = todo[text]
        low, high = 0, 1
        of, key, size = text[picked], value[picked], weight[picked]
        while len(of):
            own = mix(key + U64(high * 0xD1B54A32D192ED03 % (1 << 64)))
            doc, left, time, draw = of, size, np.zeros(len(of)), 0
            while len(doc):
                draw += 1
                bits = mix(own + U64(draw * 0x9E3779B97F4A7C15 % (1 << 64)))
                time = time - np.log(_unit(bits)) / (slots * (high - low))
                alive = time <= horizon[doc]
                own, doc, left, time, bits = own[alive], doc[alive], left[alive], time[alive], bits[alive]
                place = mix(bits + U64(1))
                below = low + _unit(mix(bits + U64(2))) * (high - low) < left if high > 1 else slice(None)
                np.minimum.at(out, (doc * slots + (place % U64(slots)).astype(np.int64))[below], time[below])
            low, high = high, 2 * high
            more = size > low
            of, key, size = of[more], key[more], size[more]
        todo &= ~np.isfinite(out.reshape(count, slots)).all(1)
        horizon = horizon * 2
    return out.reshape(count, slots)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = np.ascontiguousarray(signature).view(U64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), (len(signature), BANDS)).copy()
    for k in range(ROWS):
        key = mix(key * U64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch], piece_bytes: int = CHUNK_BYTES, lean: bool = False) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", limit=piece_bytes, lean=lean):
        bag = multiset(*shingles(part.column("text")))
        keys = band_keys(signatures(*bag, part.num_rows))
        full = np.bincount(bag[0], minlength=part.num_rows) > 0
        ends = np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[full].ravel()))
        digests = [hashlib.sha256((t or "").encode()).digest() for t in part.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("row"), part.column("doc_id"), pa.array(digests, pa.binary()), bands], ["row", "doc_id", "digest", "bands"]
        )


def numbered_windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and element of each text's set, in order: windows, and mixed with its number each further copy."""
    text, value = shingles(texts)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    head = np.ones(len(text), bool)
    head[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    copy = np.arange(len(text)) - np.maximum.accumulate(np.where(head, np.arange(len(text)), 0))
    value = np.where(copy > 0, mix(value + copy.astype(U64) * STEP), value).view(np.int64)
    order = np.lexsort((value, text))
    return text[order], value[order]


def _collect(batches: Iterator[pa.RecordBatch], piece_bytes: int = CHUNK_BYTES, lean: bool = False) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", limit=piece_bytes, lean=lean):
        text, value = numbered_windows(part.column("text"))
        ends = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
        sets = pa.ListArray.from_arrays(pa.array(ends), pa.array(value))
        yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(np.diff(ends)), sets], ["node", "size", "windows"])


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and value of each element, and the size of each list."""
    sizes = np.diff(lists.offsets.to_numpy())
    return np.repeat(np.arange(len(lists)), sizes), lists.flatten().to_numpy(zero_copy_only=False), sizes


def _compare(batches: Iterator[pa.RecordBatch], lean: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = (batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()) * 8
        ends = np.cumsum(sizes)
        for at in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1):
            if not len(at):
                continue
            part = batch.slice(int(at[0]), len(at))
            (pair, value, size_a), (pair_b, value_b, size_b) = (_flat(part.column(c)) for c in ("windows_a", "windows_b"))
            pair, value = np.concatenate([pair, pair_b]), np.concatenate([value, value_b])
            order = np.lexsort((value, pair))
            pair, value = pair[order], value[order]
            twice = (pair[1:] == pair[:-1]) & (value[1:] == value[:-1])
            shared = np.bincount(pair[1:][twice], minlength=part.num_rows)
            similar = pa.array((shared > 0) & (shared >= SIMILARITY * (size_a + size_b - shared)))
            yield pa.RecordBatch.from_arrays([part.column("a").filter(similar), part.column("b").filter(similar)], ["a", "b"])
            if lean:
                release()


def _links_inside(rows: pa.Table) -> pa.Table:
    """Links between classes of the rows (x, y, mine, root, size, windows): one for two roots whose members are alike.

    Rows are those of two blocks; only pairs with one member in each are looked at, where the blocks are two.
    """
    root, mine = rows.column("root").to_numpy(), rows.column("mine").to_numpy()
    holder, value, size = _flat(rows.column("windows").combine_chunks())
    begin = np.cumsum(size) - size
    by_value = np.argsort(value, kind="stable")
    ordered, holder = value[by_value], holder[by_value]
    names, of, counts = np.unique(root, return_inverse=True, return_counts=True)
    two = rows.column("x")[0].as_py() != rows.column("y")[0].as_py()
    links: list[tuple[int, int]] = []
    for i in np.flatnonzero(of != counts.argmax()).tolist():  # every link has an end outside the largest class
        own = value[begin[i] : begin[i] + size[i]]
        first, last = np.searchsorted(ordered, own, "left"), np.searchsorted(ordered, own, "right")
        shared = np.bincount(holder[ranges(first, last - first)], minlength=len(root))
        alike = (of != of[i]) & (shared > 0) & (shared >= SIMILARITY * (size + size[i] - shared))
        if two:
            alike &= mine != mine[i]
        for other in np.unique(of[alike]).tolist():
            # The two classes are one from here on, so that no further link between them is looked for.
            links.append((int(names[of[i]]), int(names[other])))
            of[of == other] = of[i]
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})


def _linked(pairs: DataFrame, sets: DataFrame, lean: bool = False) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(c), F.col("size").alias(f"size_{c}"), F.col("windows").alias(f"windows_{c}")) for c in "ab")
    # Bags whose sizes are further apart are never alike.
    near = F.least("size_a", "size_b") >= SIMILARITY * F.greatest("size_a", "size_b")
    return pairs.join(left, "a").join(right, "b").where(near).mapInArrow(partial(_compare, lean=lean), "a long, b long")


def classes(docs: DataFrame, piece_bytes: int = CHUNK_BYTES, lean: bool = False) -> DataFrame:
    """Class of every row of `docs` (doc_id, text): doc_id, class_id, class_rows, kept.

    Rows are in one class if a chain of pairs with weighted Jaccard similarity of 0.8 or more joins them, or if their
    texts are equal. class_id is the smallest doc_id in the class; kept marks one row of each class: of the rows with
    that id one. Texts of fewer than five words (null: empty) have no windows and are alike only if equal; for null
    texts that means all null and empty texts are one class. A null doc_id takes part, comes last, and is class_id only
    if the class has no other. Repeated rows are copies like any other. A text of any length is signed and compared as a
    whole, by one task, which needs about 40 bytes of memory for each of its own. Other columns are not looked at.

    Shorter texts are signed and cut into sets `piece_bytes` at a time; a worker needs about 100 times that. With `lean`
    workers give back after each piece what they no longer need. Smaller pieces and giving back take more time and change
    no result; without `lean` smaller pieces take more memory, as the C library keeps what lies between arrays.
    """
    sign, collect = (partial(work, piece_bytes=piece_bytes, lean=lean) for work in (_sign, _collect))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(rows.mapInArrow(sign, "row long, doc_id long, digest binary, bands array<long>"), "signatures")
    # One node for each different text.
    texts = stored(signed.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("least")), "texts")
    banded = signed.join(texts.select(F.col("node").alias("row")), "row", "left_semi")
    members = stored(banded.select(F.col("row").alias("node"), F.explode_outer("bands").alias("band")).where("band is not null"), "bands")
    buckets = members.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    grouped = stored(members.join(buckets, "band"), "buckets")
    # A bucket is compared with the member that meets the most others: of a text and its copies, the text itself.
    meets = grouped.groupBy("node").agg(F.sum("n").alias("meets"))
    best = F.max(F.struct("meets", (-F.col("node")).alias("node")))
    pivots = grouped.join(meets, "node").groupBy("band").agg(best.alias("best")).select("band", (-F.col("best.node")).alias("first"))
    star = grouped.join(pivots, "band").where("node <> first")
    pairs = stored(star.select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b")).distinct(), "pairs")

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    needed = stored(texts.join(nodes, "node"), "needed")
    read = find_texts(docs, needed).mapInArrow(collect, "node long, size int, windows array<long>")
    sets = stored(read.dropDuplicates(["node"]), "sets")

    links = stored(_linked(pairs, sets, lean), "links")
    roots = components(links)
    # The pivot has met all members. Others that are still apart are compared with each other, where the bucket is.
    placed = star.select("band", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = placed.join(sets.select("node", "size"), "node")
    apart = placed.groupBy("band").agg((F.min("root") < F.max("root")).alias("apart"), F.sum("size").alias("total")).where("apart")
    spread = placed.join(apart, "band").withColumn("blocks", F.ceil(8 * F.col("total") / BLOCK_BYTES))
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("node"), "blocks"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    spread = spread.select("band", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y"), "mine", "node", "root")
    inside = spread.join(sets, "node").drop("node").groupBy("band", "x", "y").applyInArrow(_links_inside, "a long, b long")
    more = stored(inside.distinct(), "links")
    roots = components(links.union(more)) if more.limit(1).count() else roots

    rooted = texts.join(roots, "node", "left").select("digest", "node", "least", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    of_text = stored(lookup(rooted, named, "root", spread_by=("node",)).select("digest", "root", "class_id"), "classes")
    placed = stored(signed.select("row", "doc_id", "digest").join(of_text, "digest"), "placed")
    # Of the rows that carry the class's id the first one written stays.
    carries = F.col("doc_id").eqNullSafe(F.col("class_id"))
    each = placed.groupBy("root").agg(F.count(F.lit(1)).alias("class_rows"), F.min(F.when(carries, F.col("row"))).alias("stays"))
    out = lookup(placed, each, "root", spread_by=("row",))
    return out.select("row", "doc_id", "digest", "class_id", "class_rows", (F.col("row") == F.col("stays")).alias("kept"))


def keep_one(docs: DataFrame, piece_bytes: int = CHUNK_BYTES, lean: bool = False) -> DataFrame:
    """`docs` with one row of each class; all columns stay. `piece_bytes` and `lean` are those of `classes`.

    Rows are told apart by id and text, so of rows that share both any one may stay.
    """
    placed = stored(classes(docs, piece_bytes, lean), "kept")
    same = placed.groupBy("doc_id", "digest").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    same = stored(same.where("not kept or n > 1"), "dropped")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select(own, F.col("doc_id").cast("long").alias("id"), digest(F.col("text").cast("string")).alias("digest"))

    def among(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.select(F.col("doc_id").alias("key_id"), F.col("digest").alias("key_digest"))
        keys = F.broadcast(keys) if is_small(keys) else keys
        return rows.join(keys, [rows["digest"] == keys["key_digest"], rows["id"].eqNullSafe(keys["key_id"])], how)

    out = among(same, "left_anti")
    twins = same.where("kept")
    if twins.limit(1).count():
        out = out.union(among(twins, "left_semi").dropDuplicates(["id", "digest"]))
    return out.select("own.*")
