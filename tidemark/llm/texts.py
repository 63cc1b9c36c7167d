"""Different texts of a table, and fetching some of them again without moving the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.skew import is_small
from tidemark.session import stored


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def find_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (node, text) for `wanted` (node, digest, least), from `docs` (doc_id, text), more than one only for repeated rows.

    `least` is the smallest doc_id of the rows with that text, or null if none has an id: the rows that carry it stand
    for all copies, so a text is fetched once however many copies it has. Only the wanted texts are shuffled while
    `wanted` is small enough to broadcast; beyond that both sides meet by digest and id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_digest", digest(F.col("text")))
    keys = wanted.select("node", F.col("digest").alias("_key"), F.col("least").alias("_least"))
    keys = F.broadcast(keys) if is_small(wanted) else keys
    found = rows.join(keys, [rows["_digest"] == keys["_key"], rows["_id"].eqNullSafe(keys["_least"])])
    return found.select("node", "text")


def fetch_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """One row (node, text) for each of `wanted`, stored; see `find_texts`."""
    return stored(find_texts(docs, wanted).dropDuplicates(["node"]), "texts")
