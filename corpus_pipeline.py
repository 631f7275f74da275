"""From raw documents to token ids: four of the operators, one after the other."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import bpe, cotrain, fmindex, jaccard
from shelfmark.llm.queries import WORD_TOKENIZER
from shelfmark.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return cotrain.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle Jaccard similarity 0.8 or more."""
    return jaccard.keep_one(docs, width=5, percent=80, stretch=0.5)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words that benchmark phrases cover; sizes follow."""
    return fmindex.decontaminate(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), size_col="n_chars"
    )


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    path = public_tokenizers.path(WORD_TOKENIZER)
    return bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminated", decontaminated),
    ("tokens", tokens),
]

# The classifier's fit and the tokenizer's merges are not SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = durable(docs)
    return docs
