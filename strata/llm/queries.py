"""The registered queries of the corpus operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    classifier,
    clustering,
    decontaminate,
    html_main_text,
    licenses,
    mixing,
    near_dup,
    quality,
    sharding,
    spelling,
    suffix_dedup,
    token_scan,
    warc_zip,
)
from .common import documents, pages, table
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    scanned = documents(spark, sf_dir, "doc_id", "text").select("doc_id", licenses.scan(F.col("text")).alias("s"))
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return scanned.select("doc_id", *[F.col("s")[n].alias(n) for n in names])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that the mix of sources takes, and the first output shard that holds some."""
    return mixing.words_taken(documents(spark, sf_dir, "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "first_shard"
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of risk-controlled rules for every document."""
    judged = quality.assess(documents(spark, sf_dir, "doc_id", "lang", "text"), table(spark, sf_dir, "labels"))
    counts = [F.col("c")[f].alias(f) for f in quality.FIELDS[:5]]
    return judged.select("doc_id", *counts, "base_failed", "kept", "fired")


def op1_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items leaked into every document."""
    found = decontaminate.scan(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct("leaks.item_id"))
    return found.select(
        "doc_id", "contaminated", "coverage", F.array_join(items.cast("array<string>"), ",").alias("item_ids")
    )


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = html_main_text.extract(pages(spark, sf_dir))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class and number of links of every document."""
    return near_dup.join_near(documents(spark, sf_dir, "doc_id", "text"))


def op7_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated 50-byte strings."""
    removed = suffix_dedup.remove_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC packages and read back."""
    records = warc_zip.read_archives(warc_zip.write_archives(pages(spark, sf_dir)))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return token_scan.document_tokens(documents(spark, sf_dir, "doc_id", "text"))


def op10_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = sharding.assign(documents(spark, sf_dir, "doc_id", "text"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents under their common spelling."""
    return spelling.group(documents(spark, sf_dir, "doc_id", "text"))


def op12_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classifier.classify(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels"))


def op13_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector."""
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_string_tiling": op1_string_tiling,
    "op2_site_style_tree": op2_site_style_tree,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_license_rules": op4_license_rules,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_deep_shallow": op7_deep_shallow,
    "op8_zip_warc": op8_zip_warc,
    "op9_separator_scan": op9_separator_scan,
    "op10_hash_ring": op10_hash_ring,
    "op11_pivotal_grams": op11_pivotal_grams,
    "op12_positive_unlabelled": op12_positive_unlabelled,
    "op13_orchard": op13_orchard,
}
