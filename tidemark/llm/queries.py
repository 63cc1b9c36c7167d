"""Queries over the given tables, one for each operator of this folder, and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    decontaminate,
    importance,
    license_scan,
    lm_score,
    near_dup,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    sentence_pieces,
    suffix_dedup,
    topk_search,
    warc,
)
from tidemark.llm.oracle import SQL
from tidemark.llm.workers import importable
from tidemark.session import tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(importable(spark)).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(table(spark, sf_dir, "pages"), least_bytes=0, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    out = sentence_pieces.with_pieces(docs)
    return out.select("doc_id", "n_pieces", "piece_ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_rows", "kept")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Documents have no path of their own: one folder for each source, and in it one for each language.
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    return license_scan.scan(files)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.summarise(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, F.col("vec_id") % topk_search.EVERY == 0)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.summarise(table(spark, sf_dir, "documents"), periodic_runs.made_periodic)


__all__ = ["QUERIES", "SQL", "table"]

QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_quality_classifier,
        op3_quality_rules,
        op4_suffix_dedup,
        op5_warc,
        op6_sentence_pieces,
        op7_near_dup,
        op8_license_scan,
        op9_lm_score,
        op10_secret_scan,
        op11_importance,
        op12_topk_search,
        op13_periodic_runs,
    )
}
