"""Text to vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.scores import norm

# Texts per request for dataset profiles and for columns.
PROFILE_BATCH = 128
COLUMN_BATCH = 500

# Prompts per request of a judging model.
PROMPT_BATCH = 20

EmbedFn = Callable[[list[str]], Sequence]
AskFn = Callable[[list[str]], Sequence]


def _in_order(result: Sequence) -> list[np.ndarray]:
    """Vectors of a response; items that carry an index are put in its order."""
    items = list(result)
    if items and isinstance(items[0], dict):
        items = [i["embedding"] for i in sorted(items, key=lambda i: i["index"])]
    return [np.asarray(v, dtype=np.float32) for v in items]


def _answers(result: Sequence) -> list[str]:
    return [None if a is None else str(a) for a in result]


def _called(
    df: DataFrame, text: str, fn: Callable, read: Callable[[Sequence], list], field: T.StructField, batch_size: int
) -> DataFrame:
    """Add what ``fn`` returns for batches of texts, and ``error``.

    When a batch fails its texts are tried one by one; a text that still fails gets a NULL
    and the error, and can be retried by a later run (see ``pending``). Columns besides the
    text stay as they are.
    """
    out = T.StructType([*df.schema.fields, field, T.StructField("error", T.StringType())])

    def several(texts: list[str]) -> list:
        got = read(fn(texts))
        if len(got) != len(texts):
            raise ValueError(f"{len(got)} results for {len(texts)} texts")
        return got

    def one(value: str) -> tuple[object, str | None]:
        try:
            return several([value])[0], None
        except Exception as e:  # noqa: BLE001 - whatever the model call raises is the row's error
            return None, f"{type(e).__name__}: {e}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size].copy()
                texts = part[text].tolist()
                try:
                    results = several(texts)
                    errors: list[str | None] = [None] * len(texts)
                except Exception:  # noqa: BLE001
                    pairs = [one(t) for t in texts]
                    results, errors = [p[0] for p in pairs], [p[1] for p in pairs]
                part[field.name] = pd.Series(results, index=part.index, dtype=object)
                part["error"] = pd.Series(errors, index=part.index, dtype=object)
                yield part

    return df.mapInPandas(run, out)


def embed(df: DataFrame, text: str, fn: EmbedFn, batch_size: int = PROFILE_BATCH) -> DataFrame:
    """Add ``vector`` and ``error`` by calling ``fn`` on batches of texts (see :func:`_called`)."""
    field = T.StructField("vector", T.ArrayType(T.FloatType()))
    return _called(df, text, fn, _in_order, field, batch_size)


def ask(df: DataFrame, text: str, fn: AskFn, batch_size: int = PROMPT_BATCH) -> DataFrame:
    """Add ``answer`` and ``error`` by calling a text-to-text ``fn`` on batches of prompts."""
    return _called(df, text, fn, _answers, T.StructField("answer", T.StringType()), batch_size)


def hash_embed(df: DataFrame, id_col: str, tokens: Column, dim: int = 64) -> DataFrame:
    """A model-free stand-in for ``embed``: (id, vector) of hashed word counts, unit length.

    The bucket of a word comes from the first eight hex digits of its MD5. Stays in the JVM.
    """
    bucket = F.conv(F.substring(F.md5(F.col("w").cast("binary")), 1, 8), 16, 10).cast("bigint") % dim
    words = df.select(F.col(id_col).alias("id"), F.explode(tokens).alias("w"))
    # one count per bucket, combined before the shuffle
    sums = [F.count_if(F.col("b") == i).alias(f"b{i}") for i in range(dim)]
    dense = F.array(*[F.col(f"b{i}").cast("double") for i in range(dim)])
    raw = words.select("id", bucket.cast("int").alias("b")).groupBy("id").agg(*sums).select("id", dense.alias("v")).withColumn("len", norm("v"))
    return raw.select(
        "id", F.transform("v", lambda x: F.when(F.col("len") > 0, x / F.col("len")).otherwise(0.0)).alias("vector")
    )
