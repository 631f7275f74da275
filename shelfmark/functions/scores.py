"""Similarity scores as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import words
from shelfmark.functions.values import col, truthy


@dataclass(frozen=True)
class Weights:
    columns: float = 0.65
    title: float = 0.25
    temporal: float = 0.10
    embedding: float = 0.0


# The scoring in use, and the planned one with an embedding term.
DEFAULT_WEIGHTS = Weights()
PLANNED_WEIGHTS = Weights(columns=0.30, title=0.15, temporal=0.10, embedding=0.45)

# Fixed value: two column vectors at least this close mean the same thing.
COLUMN_MATCH = 0.85


def jaccard(a: str | Column, b: str | Column) -> Column:
    """Shared share of two arrays of distinct values; 0 when either is empty."""
    a, b = col(a), col(b)
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / union).otherwise(F.lit(0.0))


def token_overlap(a: str | Column, b: str | Column) -> Column:
    return jaccard(words(a), words(b))


def norm(v: str | Column) -> Column:
    return F.sqrt(
        F.aggregate(
            col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
        )
    )


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine of two vectors of one length, 0 when either has no direction."""
    a, b = col(a), col(b)
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    dot = F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)
    scale = norm(a) * norm(b)
    same_length = F.size(a) == F.size(b)
    return F.when(
        same_length, F.when(scale > 0, dot / scale).otherwise(F.lit(0.0))
    ).otherwise(F.raise_error(F.lit("vectors differ in length")).cast("double"))


def temporal_compat(
    frequency_a: Column, covered_a: Column, frequency_b: Column, covered_b: Column
) -> Column:
    """Half for the same known frequency, half when both sides state their coverage.

    Coverage counts when it is present on both sides; the periods need not overlap.
    """
    same = F.coalesce(truthy(frequency_a) == truthy(frequency_b), F.lit(False))
    return F.when(same, 0.5).otherwise(0.0) + F.when(covered_a & covered_b, 0.5).otherwise(0.0)


def is_covered(start: str | Column, end: str | Column) -> Column:
    return truthy(start).isNotNull() & truthy(end).isNotNull()


def weighted_score(
    columns: Column,
    title: Column,
    temporal: Column,
    weights: Weights = DEFAULT_WEIGHTS,
    embedding: Column | None = None,
) -> Column:
    score = columns * weights.columns + title * weights.title + temporal * weights.temporal
    if embedding is not None and weights.embedding:
        score = score + embedding * weights.embedding
    return score


def explain_match(shared: Column, same_category: Column, same_organization: Column) -> Column:
    """Why two datasets were matched; fixed wording, at most five shared columns named."""
    named = F.when(
        F.size(shared) > 0,
        F.concat(F.lit("shared columns: "), F.array_join(F.slice(shared, 1, 5), ", ")),
    )
    reasons = F.concat_ws(
        "; ",
        named,
        F.when(same_category, F.lit("same category")),
        F.when(same_organization, F.lit("same organization")),
    )
    return F.coalesce(truthy(reasons), F.lit("similar title and schema"))
