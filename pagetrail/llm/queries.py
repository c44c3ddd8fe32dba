"""Registered queries of the training-data operators; ``ORACLES`` has the DuckDB SQL of those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm import byte_bpe, decontaminate, fingerprint, html_text, jaccard_join, licences, periodic_runs, preferences, sharding, substring_dedup, toxicity, warc, whitening
from pagetrail.llm.common import documents
from pagetrail.llm.oracles import ORACLES


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(documents(spark, sf_dir), k=3, percent=90)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(documents(spark, sf_dir), 16)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.passages(documents(spark, sf_dir))


def op4_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = byte_bpe.decode(byte_bpe.encode(documents(spark, sf_dir), path, public_tokenizers.PATTERN), path)
    return decoded.select("doc_id", *byte_bpe.digests())


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preferences.format_answers(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    spans = lambda c: F.concat_ws(",", F.transform(c, lambda x: F.concat_ws("-", x["start"], x["stop"])))
    return pairs.withColumn("chosen_mask", spans("chosen_mask")).withColumn("rejected_mask", spans("rejected_mask"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(documents(spark, sf_dir))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 32)


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in documents whose id's hash is divisible by ten, words from ``a`` on repeat the ``p`` there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when((h % 10 == 0) & F.col("text").isNotNull(), F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    rows = docs.select("doc_id", "text", F.floor(h / 10).cast("bigint").alias("g"), words.alias("words"))
    n = F.size("words").cast("bigint")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("left", n - F.col("a"))
    rows = rows.withColumn("p", F.lit(1) + F.floor(F.col("left") / (3 + F.col("g") % 8)))
    a, p, left = (F.col(c).cast("int") for c in ("a", "p", "left"))
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil(left / p).cast("int"))), F.lit(1), left)
    return rows.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.slice("words", F.lit(1), a), tail), " ")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse(with_periodic_tails(documents(spark, sf_dir))).withColumn("best", periodic_runs.strongest())
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = warc.write(pages.select(F.col("page_id").alias("record_id"), F.col("url").alias("target_uri"), F.col("html").alias("payload")))
    page = lambda c: F.regexp_extract(c, r"^urn:x-record:(-?\d+)$", 1).try_cast("bigint")
    return warc.read(archives).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_sharding": op2_sharding,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_licence_scan": op4_licence_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_html_extraction": op10_html_extraction,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_warc": op13_warc,
}

__all__ = ["ORACLES", "QUERIES"]
