"""Semantic index and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scores import COLUMN_MATCH
from shelfmark.functions.text import normalize_column
from shelfmark.operators.embed import COLUMN_BATCH, PROFILE_BATCH, EmbedFn, embed
from shelfmark.operators.groups import skew_join
from shelfmark.operators.rank import diversify, last_wins
from shelfmark.operators.upsert import pending, upsert_vectors
from shelfmark.operators.vectors import overfetch_topk, resolve_candidates, vector_pairs, vector_topk
from shelfmark.plans.records import column_entries, unique_columns
from shelfmark.plans.similar import ColumnMatches, ColumnVectors, Options, column_matches, frame, present, scope_keys
from shelfmark.session import durable


def profile_hash(text: str | Column = "profile") -> Column:
    return F.sha2(F.col(text) if isinstance(text, str) else text, 256)


def embedded_pending(
    profiles: DataFrame,
    payload: DataFrame,
    stored: DataFrame,
    fn: EmbedFn,
    key: str = "profile",
    batch_size: int = PROFILE_BATCH,
) -> DataFrame:
    """Vectors of what is new: id, vector, payload, profile_hash, error.

    ``profiles`` holds id and profile, ``payload`` id and payload, ``stored`` id, vector,
    payload, profile_hash, error. With ``key="profile"`` a changed profile is embedded
    again, with ``key="id"`` every id is embedded once; one that failed is tried again.
    """
    todo = profiles.select("id", "profile").withColumn("profile_hash", profile_hash())
    keys = ["id", "profile_hash"] if key == "profile" else ["id"]
    return (
        embed(pending(todo, stored, keys), "profile", fn, batch_size)
        .join(payload.select("id", "payload"), "id", "left")
        .select("id", "vector", "payload", "profile_hash", "error")
    )


def index_datasets(
    profiles: DataFrame,
    payload: DataFrame,
    stored: DataFrame,
    fn: EmbedFn,
    key: str = "profile",
    batch_size: int = PROFILE_BATCH,
) -> DataFrame:
    """Stored vectors after embedding what is new (:func:`embedded_pending`)."""
    new = embedded_pending(profiles, payload, stored, fn, key, batch_size)
    return upsert_vectors(stored, durable(new))


def index_columns(columns: DataFrame, fn: EmbedFn, batch_size: int = COLUMN_BATCH) -> DataFrame:
    """Vectors of the distinct column titles: id, title, semantic_string, vector, error."""
    titles = unique_columns(column_entries(columns), "ord")
    return embed(titles.select("id", "title", "semantic_string"), "semantic_string", fn, batch_size)


def _named(column_vectors: DataFrame, key: str) -> DataFrame:
    """(name, vector) of the columns that have one."""
    have = column_vectors.where(F.col("vector").isNotNull())
    if key == "normalized":
        keyed = have.withColumn("name", normalize_column("title"))
        keyed = last_wins(keyed, ["name"], "title")
    else:
        keyed = have.withColumn("name", F.col("title"))
    return keyed.select("name", "vector")


def column_vectors(vectors: DataFrame, threshold: float = COLUMN_MATCH, key: str = "normalized") -> ColumnVectors:
    """The same choice of columns as :func:`column_similarity`, without a list of matches."""
    if threshold <= 0:
        raise ValueError("a pair search needs a positive threshold")
    return ColumnVectors(durable(_named(vectors, key)), threshold)


def column_similarity(
    column_vectors: DataFrame, threshold: float = COLUMN_MATCH, key: str = "normalized", **options
) -> ColumnMatches:
    """Columns whose vectors reach the threshold, for ``similar_datasets``.

    ``column_vectors`` holds title and vector. Records carry normalised column names, so by
    default vectors are keyed by the normalised title, the last raw title winning.
    ``key="raw"`` keeps raw titles: a column then counts only if its normalised name is
    also somebody's raw title. Columns with equal vectors are searched once.
    """
    named = durable(_named(column_vectors, key).withColumn("h", F.xxhash64("vector")))
    reps = named.groupBy("h", "vector").agg(F.min("name").alias("rep"))
    reps = durable(reps)
    names = skew_join(named.select("name", "h", "vector"), reps, ["h", "vector"]).select("name", "rep")
    points = reps.select(F.col("rep").alias("id"), "vector")
    pairs = vector_pairs(points, points, threshold, **options).select(
        F.col("query_id").alias("a"), F.col("id").alias("b"), F.col("score").alias("sim")
    )
    return column_matches(names, pairs)


def search_text(
    queries: DataFrame,
    corpus: DataFrame,
    fn: EmbedFn,
    k: int = 5,
    threshold: float = 0.0,
    text: str = "text",
) -> DataFrame:
    """Embed query texts (id, text) and return their k nearest datasets with payload."""
    asked = durable(embed(queries, text, fn).where(F.col("vector").isNotNull()))
    hits = vector_topk(asked, corpus, k, threshold)
    rest = [c for c in corpus.columns if c != "vector"]
    return hits.join(corpus.select(*rest), "id")


def neighbors(vectors: DataFrame, records: DataFrame, k: int = 5, targets: DataFrame | None = None) -> DataFrame:
    """Nearest datasets by vector, titles from the records, else from the stored payload."""
    asked = vectors if targets is None else vectors.join(targets.select("id"), "id", "left_semi")
    hits = vector_topk(asked, vectors, k, drop_self=True)
    stored = vectors.select(
        "id",
        F.col("payload.name").alias("stored_name"),
        F.col("payload.category").alias("category"),
        F.col("payload.org").alias("organization"),
    )
    titles = records.select("id", F.col("title").alias("known_title"))
    return (
        hits.join(stored, "id")
        .join(titles, "id", "left")
        .select(
            F.col("query_id").alias("target_id"),
            "rank",
            F.col("id").alias("dataset_id"),
            F.coalesce("known_title", "stored_name", F.lit("")).alias("title"),
            F.round("score", 4).alias("score"),
            "category",
            "organization",
        )
    )


def embedding_only(vectors: DataFrame, records: DataFrame, k: int = 5, overfetch: int | None = None) -> DataFrame:
    """Global list by vector alone, known datasets only.

    With ``overfetch`` the search asks for k + overfetch and drops afterwards, so fewer than
    k rows may be left; without it unknown datasets are dropped before counting.
    """
    if overfetch is not None:
        hits = overfetch_topk(vectors, vectors, records, k, overfetch)
    else:
        known = vectors.join(records.select("id"), "id", "left_semi")
        hits = vector_topk(vectors, known, k, drop_self=True)
    return hits.join(records.select("id", "title"), "id").select(
        F.col("query_id").alias("target_id"),
        "rank",
        F.col("id").alias("dataset_id"),
        "title",
        F.round("score", 4).alias("score"),
        F.lit("embedding similarity from stored vectors").alias("reason"),
    )


def candidate_pool(vectors: DataFrame, records: DataFrame, pool: int = 75, k: int = 5) -> DataFrame:
    """(target_id, id): the vector neighbours that a rerank scores."""
    hits = vector_topk(vectors, vectors, max(pool, k + 10))
    return resolve_candidates(hits, records).select(F.col("query_id").alias("target_id"), "id")


def live_rank(
    records: DataFrame,
    fn: EmbedFn,
    options: Options = Options(),
    scopes: tuple[str, ...] = ("global", "category", "organization"),
) -> DataFrame:
    """Embed every profile once and rank by cosine within each scope, one per series."""
    recs = frame(records, options)
    texts = records.select("id", "profile").where(F.col("profile") != "")
    vectors = durable(embed(texts, "profile", fn).where(F.col("vector").isNotNull()).select("id", "vector"))
    best = None
    for scope in scopes:
        side = vectors.join(
            recs.select("id", "series", F.explode(scope_keys(scope)).alias("scope_key")), "id"
        )
        hits = vector_topk(
            side, side, options.k, drop_self=True, within="scope_key", one_per="series"
        ).drop("rank")
        hits = hits.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        ranked = diversify(
            hits.join(recs.select("id", "series"), "id"),
            ["query_id"],
            "series",
            [F.col("score").desc(), F.col("id").asc()],
            options.k,
        )
        part = ranked.select(
            F.lit(scope).alias("scope"), F.col("query_id").alias("target_id"), "id", "rank", "score"
        )
        best = part if best is None else best.unionByName(part)
    return present(best, recs, "embedding similarity from live embedding")
