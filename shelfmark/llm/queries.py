"""The operators over the whole shared tables, with their production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    audit, backoff, bpe, chat, cotrain, e8, fmindex, hadamard, jaccard, oneperm, patience, sharding,
)
from shelfmark.llm.urlmodel import Rule, filter_urls

CHAT_TOKENIZER = "byte_bpe_50k.json"
WORD_TOKENIZER = "word_bpe_49k.json"
SHARD_BYTES = 1 << 20
URL_RULES = (
    Rule("allow", "org/"),
    Rule("block", "example.org/es/"),
    Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"),
    Rule("block", "com/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_cotrain_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score_quality(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op3_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return e8.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], turns.schema)
    formatted = chat.format_conversations(
        turns.union(extra), public_tokenizers.path(CHAT_TOKENIZER)
    )
    return chat.read_back(formatted)


def op5_backoff_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(_table(spark, sf_dir, "documents")).withColumn(
        "log_score", F.round("log_score", 6)
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = patience.scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_licenses"),
        F.concat_ws(",", F.transform("licenses", lambda x: x["name"])).alias("names"),
        F.round(F.array_max(F.transform("licenses", lambda x: x["coverage"])), 6).alias("coverage"),
        F.array_min(F.transform("licenses", lambda x: x["first"])).alias("first_word"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"), width=3, percent=90)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fmindex.find_spans(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"),
    )
    covered = F.aggregate(
        "spans", F.lit(0).cast("bigint"), lambda n, s: n + s.getItem(1) - s.getItem(0)
    )
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(WORD_TOKENIZER)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, path).select("doc_id", "ids")
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return bpe.decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARD_BYTES)


def op11_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hadamard.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = oneperm.with_next(_table(spark, sf_dir, "documents"))
    head, cut = F.col("next_head"), F.floor(F.col("n_chars") / 3).cast("int")
    own = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut).cast("int"))
    edited = docs.withColumn("edited", F.concat(own, F.left(head, cut)))
    prints = edited.withColumn(
        "edited_print", F.when(head.isNotNull(), oneperm.fingerprint(F.col("edited")))
    )
    return prints.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        oneperm.as_hex(F.col("print")).alias("fingerprint"),
        oneperm.as_hex(F.col("edited_print")).alias("edited_fingerprint"),
        oneperm.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        oneperm.likeness(F.col("print"), F.col("next_print")).alias("near_next"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_cotrain_quality, op2_url_filter, op3_lattice_dedup, op4_chat_format,
        op5_backoff_score, op6_license_scan, op7_jaccard_join, op8_decontaminate,
        op9_bpe_roundtrip, op10_extendible_shards, op11_hadamard_clusters,
        op12_document_fingerprints, op13_filter_audit,
    )
}
