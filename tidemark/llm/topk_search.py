"""Exact top-k search by inner product, from sorted lists read in order only.

Vectors become whole numbers. Candidates are dealt into blocks; in a block each dimension is a list of the candidates
sorted by their component, which a query reads from the top where its own component is positive and from the bottom
where it is negative. Down to some depth of all lists a candidate's score has two bounds: components read count as they
are, and an unread one lies between the value where reading stands (upper bound) and the far end of the list (lower
bound). A candidate whose upper bound stays below the k-th best lower bound of its query cannot be among the k best of
the block. Depth grows, halving what is unread, until at most `POOL` candidates are left that can; no outsider qualifies
any more, and the scores of those left are resolved. At full depth both bounds are the score, so reading always ends.

Reading is done for many queries at once: an upper bound is the query's positive part times max(x, value at the depth)
plus its negative part times min(x, value at the depth), a product of two matrices.

Query and candidate rows meet by the key (block of queries, block of candidates), each block of bounded size, and only k
rows for each query leave a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stored

SCALE = 256
TOP = 5
EVERY = 50  # rows whose id this number divides are the queries
CANDIDATE_ROWS = 32_768  # rows of a block at most, about
QUERY_ROWS = 8_192
LEAST_ROWS = 512  # blocks are not cut smaller to give every core work
TOGETHER = 128  # queries whose bounds a task holds at once
POOL = 32
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}  # whole numbers below are exact, and so are their products and sums


def whole_vectors(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Add `v`: floor(scale * x) of each component; only rows whose vector and components are all finite are left."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return rows.where(F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("v", whole)


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = lists.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat.flatten().to_numpy(zero_copy_only=False)
    return out


def _number_kind(queries: np.ndarray, candidates: np.ndarray) -> type:
    """The number type in which all scores and bounds are exact."""
    largest = [int(max(abs(int(m.min(initial=0))), int(m.max(initial=0)))) for m in (queries, candidates)]
    bound = 2 * largest[0] * largest[1] * queries.shape[1]
    if bound >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit a 64-bit integer")
    return next((kind for kind, limit in EXACT.items() if bound < limit), np.int64)


class SortedLists:
    """The components of a block of candidates as one sorted list for each dimension."""

    def __init__(self, candidates: np.ndarray) -> None:
        self.values = candidates
        self.lists = np.sort(candidates, axis=0)

    def bounds(self, depth: int) -> tuple[np.ndarray, ...]:
        """What is known of each component after `depth` entries: its upper and lower bound, read from the top, and its
        lower and upper bound, read from the bottom."""
        x, n = self.values, len(self.values)
        high, low = self.lists[n - depth], self.lists[depth - 1]
        least, most = self.lists[0], self.lists[-1]
        return np.maximum(x, high), np.where(x >= high, x, least), np.minimum(x, low), np.where(x <= low, x, most)


def _depths(n: int) -> list[int]:
    left, out = n // 4, []
    while left:
        out.append(n - left)
        left //= 2
    return [*out, n]


def search_block(queries: np.ndarray, query_rows: np.ndarray, candidates: np.ndarray, candidate_rows: np.ndarray, names: np.ndarray, k: int) -> list[np.ndarray]:
    """Per query its k best candidates other than itself: query row, candidate row and score, each as one array.

    `names` puts candidates of equal score in order, the smallest first.
    """
    kind = _number_kind(queries, candidates)
    queries, lists = queries.astype(kind), SortedLists(candidates.astype(kind))
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    own = candidate_rows[None, :] == query_rows[:, None]
    found: list[tuple[np.ndarray, ...]] = []
    todo, n = np.arange(len(queries)), len(candidates)
    lowest = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    for depth in _depths(n):
        top_high, top_low, end_low, end_high = lists.bounds(depth)
        lower = up[todo] @ top_low.T + down[todo] @ end_high.T
        lower[own[todo]] = lowest
        if n > k:
            worst = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            worst = lower.min(axis=1, initial=0)
        able = up[todo] @ top_high.T + down[todo] @ end_low.T >= worst[:, None]
        able &= ~own[todo]
        done = able.sum(axis=1) <= (POOL if depth < n else n)
        at, candidate = np.nonzero(able[done])
        query = todo[done][at]
        score = np.einsum("ij,ij->i", queries[query], lists.values[candidate]).astype(np.int64)
        order = np.lexsort((candidate_rows[candidate], names[candidate], -score, query))
        query, candidate, score = query[order], candidate[order], score[order]
        best = np.arange(len(query)) - np.searchsorted(query, query) < k
        found.append((query_rows[query[best]], candidate_rows[candidate[best]], score[best]))
        todo = todo[~done]
        if not len(todo):
            break
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def _search(both: pa.Table, k: int) -> pa.Table:
    out = []
    queries, candidates = both.filter(both.column("asks")), both.filter(pc.invert(both.column("asks")))
    if queries.num_rows and candidates.num_rows:
        width = max(int(np.diff(t.column("v").combine_chunks().offsets.to_numpy()).max()) for t in (queries, candidates))
        q, c = (_matrix(t.column("v"), width) for t in (queries, candidates))
        query_rows, rows = queries.column("row").to_numpy(), candidates.column("row").to_numpy()
        name = candidates.column("vec_id").combine_chunks()
        last = np.iinfo(np.int64).max
        names = name.fill_null(last).to_numpy(zero_copy_only=False)
        for at in range(0, len(q), TOGETHER):
            out.append(search_block(q[at : at + TOGETHER], query_rows[at : at + TOGETHER], c, rows, names, k))
        ids = dict(zip(rows.tolist(), name.to_pylist(), strict=True))
        of = dict(zip(query_rows.tolist(), queries.column("vec_id").to_pylist(), strict=True))
    query, row, score = (np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))
    return pa.table(
        {
            "query_row": query, "row": row, "score": score,
            "query_id": pa.array([of[r] for r in query.tolist()] if out else [], pa.int64()),
            "vec_id": pa.array([ids[r] for r in row.tolist()] if out else [], pa.int64()),
        }
    )


def _block(rows: int, most: int, parts: int) -> int:
    """Into how many blocks to deal so many rows: by their size, or at least one for each core."""
    return max(-(-rows // most), min(parts, -(-rows // LEAST_ROWS)), 1)


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of `vectors` (vec_id, vector) that is a query its k best other rows.

    Scores are inner products of floor(scale * x), as whole numbers. Ties go to the smaller vec_id, a null id last, and
    among repeated rows to any one. A repeated row is a candidate for its copies, and each query row has its own k rows
    (fewer, if there are no more candidates). Vectors null or with a null or non-finite component take no part, neither
    do null results of `is_query`; of vectors of unequal length the shorter is filled with zeros, so an empty one scores
    0. Components so large that an inner product leaves 64 bits raise an error. Empty tables give no rows. Columns other
    than the two are only seen by `is_query`.
    """
    spark = vectors.sparkSession
    marked = whole_vectors(vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))), vector, scale)
    rows = stored(marked.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "is_query", "v"), "vectors")
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    cores = spark.sparkContext.defaultParallelism
    blocks, query_blocks = _block(n, CANDIDATE_ROWS, 4 * cores), _block(n_queries, QUERY_ROWS, 1)

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int) -> DataFrame:
        columns = {own: F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(others - 1)))}
        asks = F.lit(own == "query_block").alias("asks")
        return df.withColumns(columns).select("row", "vec_id", "v", asks, "query_block", "block")

    queries = dealt(rows.where("is_query"), "query_block", query_blocks, "block", blocks)
    both = queries.union(dealt(rows, "block", blocks, "query_block", query_blocks))

    def search(group: pa.Table) -> pa.Table:
        return _search(group, k)

    near = both.groupBy("query_block", "block").applyInArrow(search, "query_row long, row long, score long, query_id long, vec_id long")
    place = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
    best = near.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
