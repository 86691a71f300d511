"""Registered queries of the training-data operators: each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprints, language_id, licenses, lm, near_dup, packing, pii, prefix_trie, quality, repeats, warc, whiten
from .common import read_table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.line_frequency(read_table(spark, sf_dir, "documents"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    model = language_id.fit(docs.where(remainder != 2).select("text", "lang"))
    out = language_id.predict(docs, model)
    return out.withColumn("held_out", remainder == 2)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.round_trip(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


@query
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edited(read_table(spark, sf_dir, "documents"))


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(read_table(spark, sf_dir, "documents"), passage=repeats.PASSAGE)


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), words=near_dup.WORDS)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    out = lm.score(docs.select("doc_id", "text", (~held_out).alias("train")))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


SQL["op12_license_scan"] = licenses.scan_sql()


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.report(read_table(spark, sf_dir, "embeddings"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))
