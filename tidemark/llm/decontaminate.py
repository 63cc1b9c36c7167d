"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

A short item inside a long document has a tiny Jaccard similarity, so signatures of whole documents cannot find it.
Containment can: items are partitioned by their number of five-word shingles, and each partition has a sketch size. An
item's sketch holds its smallest shingle hashes (a bottom-k MinHash under one hash function). A document that holds at
least the fraction `CONTAINED` of an item's n shingles misses at most (1 - CONTAINED) * n of them, so a sketch of one
more than that always shares a value with it: the sketch sizes are chosen so, and no document is missed. Every
document shingle is tested, no document sketch is needed. Candidates are then verified on the shingles themselves.

Words are lower-cased. Items of fewer than five words have no shingle and match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.words import WINDOW_WORDS, add_word_hashes, window_hashes, words
from tidemark.operators.skew import is_small
from tidemark.session import stored

CONTAINED = 0.8


def _word_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("_words", words(F.lower("_text")))


def _shingles(words_col: str) -> Column:
    """Distinct shingles as text."""
    count = F.size(words_col) - (WINDOW_WORDS - 1)
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(F.col(words_col), i, WINDOW_WORDS), " ")))


def sketches(items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """Rows (_hash, _item) from items (_item, _text): the sketch of each item, sized by the partition its number of shingles falls in.

    Partitions are powers of two: with up to 2^j shingles, one more than the misses that 2^j of them allow.
    """
    hashed = add_word_hashes(_word_rows(items), "_words", "_hashes").withColumn("_all", F.array_distinct(window_hashes("_hashes")))
    largest = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size("_all"), F.lit(1)))))
    # 1 - contained is not exact in binary; a little more can only enlarge the sketch.
    keep = (F.floor(largest * (1 - contained) + 1e-6) + 1).cast("int")
    small = hashed.select("_item", F.slice(F.sort_array("_all"), F.lit(1), keep).alias("_sketch"))
    return small.select(F.explode_outer("_sketch").alias("_hash"), "_item").where("_hash is not null").distinct()


def contaminated(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """Rows (doc_id, item_id, n_item, n_shared, containment) for every document that holds enough of an item.

    `docs` has doc_id and text, `items` item_id and text; other columns are not looked at. Null texts count as empty.
    Rows with equal id and text give one result row; rows with a null id are reported with a null id. Rows of one id
    with other texts are judged each, and the larger share is reported. Empty tables give an empty result.
    """
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("_text")).distinct().withColumn("_item", F.sha2("_text", 256))
    ids, items = items.select("item_id", "_item"), items.select("_item", "_text").distinct()
    shingled = stored(_word_rows(items).select("_item", _shingles("_words").alias("_shingles")).where("size(_shingles) > 0"), "item-shingles")
    sketch = stored(sketches(items, contained), "sketches")
    top = sketch.agg(F.max("_hash")).first()[0]
    if top is None:  # no item has a shingle
        return docs.limit(0).select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in RESULT.items()])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    hashed = add_word_hashes(_word_rows(rows.withColumn("_key", F.sha2("_text", 256))), "_words", "_hashes")
    hashed = hashed.withColumn("_windows", window_hashes("_hashes"))
    # No sketch value lies above the largest one, so larger hashes need not leave the row.
    low = hashed.select("doc_id", "_key", F.explode_outer(F.filter("_windows", lambda h: h <= top)).alias("_hash")).where("_hash is not null")
    known = F.broadcast(sketch) if is_small(sketch) else sketch
    candidates = stored(low.join(known, "_hash").select("doc_id", "_key", "_item").distinct(), "candidates")

    wanted = candidates.join(shingled, "_item").withColumnRenamed("doc_id", "_id").withColumnRenamed("_key", "_k")
    keys = stored(candidates.select(F.col("doc_id").alias("_id"), F.col("_key").alias("_k")).distinct(), "candidate-keys")
    source = rows.withColumn("_key", F.sha2("_text", 256))
    match = [source["_key"] == keys["_k"], source["doc_id"].eqNullSafe(keys["_id"])]
    held = source.join(F.broadcast(keys) if is_small(keys) else keys, match, "left_semi")
    texts = stored(_word_rows(held.dropDuplicates(["doc_id", "_key"])).select("doc_id", "_key", _shingles("_words").alias("_own")), "candidate-shingles")
    both = texts.join(wanted, [texts["_key"] == wanted["_k"], texts["doc_id"].eqNullSafe(wanted["_id"])])
    both = both.withColumn("n_shared", F.size(F.array_intersect("_own", "_shingles")).cast("long"))
    both = both.withColumn("n_item", F.size("_shingles").cast("long"))
    hit = both.where(F.col("n_shared") >= F.lit(contained) * F.col("n_item") - 1e-9)
    found = hit.join(ids, "_item").groupBy("doc_id", "item_id", "n_item").agg(F.max("n_shared").alias("n_shared"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


RESULT = {"item_id": "bigint", "n_item": "bigint", "n_shared": "bigint", "containment": "double"}


def clean(docs: DataFrame, items: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """Rows of `docs` that hold no item. Rows with a null id are judged together: all go if one of them holds an item."""
    found = stored(contaminated(docs, items, contained).select(F.col("doc_id").alias("_id")).distinct(), "contaminated")
    return docs.join(F.broadcast(found) if is_small(found) else found, docs["doc_id"].eqNullSafe(found["_id"]), "left_anti")
