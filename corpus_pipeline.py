"""Cleaning a corpus in stages, each written as Parquet and read again as the documents of the next.

Every stage gives an empty table for an empty one, takes null and empty texts and ids like any others, looks at texts as a
whole however long, and returns the columns of `documents` alone (the last one its own): further columns of its input,
whatever their names, are left out. Ties are settled by id, as each docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, near_dup, quality_rules, secret_scan, sentence_pieces
from tidemark.llm.queries import table
from tidemark.llm.workers import importable
from tidemark.session import scratch_path, tune

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# All stages share their executors: the heap that one has filled stays full in the next, and Python workers live on. So
# workers take little at a time and give back what they no longer need.
PIECE_BYTES = 1 << 18


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    A null or empty text has no words and goes. Repeated rows are judged alike and all stay or all go; no verdict
    depends on an order. Rows of one id share its label.
    """
    rated = quality_rules.rate(docs, table(spark, sf_dir, "labels"))
    return rated.where("kept").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    The row with the smallest id of a group stays, of rows that repeat that id one; a null id comes last. Null and empty
    texts are one group. Texts under five words are alike only if equal.
    """
    tune(importable(spark))
    return near_dup.keep_one(docs, piece_bytes=PIECE_BYTES, lean=True).select(*COLUMNS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay. Repeated rows go or stay together, and so do all rows with a null id.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and `n_chars` counted anew.

    Every row stays, repeated rows are masked alike, and null texts stay null with a null `n_chars`.
    """
    tune(spark)
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document.

    Every row gives one row, repeated rows too; null and empty texts have no pieces.
    """
    tune(importable(spark))
    pieced = sentence_pieces.with_pieces(docs, batch_bytes=PIECE_BYTES, lean=True)
    return pieced.select("doc_id", "lang", "source", "n_pieces", "piece_ids")


STAGES = [
    ("quality_rules", quality),
    ("near_dup", one_of_each),
    ("decontaminate", no_benchmark),
    ("secret_scan", no_secrets),
    ("sentence_pieces", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
