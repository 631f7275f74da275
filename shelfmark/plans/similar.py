"""Similar datasets by columns, title and time, for all datasets in one job.

The score of a pair is a weighted sum of column overlap, title overlap, temporal
compatibility and, where the weights ask for it, the cosine of two record vectors. Instead
of scoring all pairs:

1. every target gets a few candidates at hand (neighbours on its rarest columns and title
   words and by vector, and the first series of its scope); their k-th best score is a floor,
2. a pair above the floor must reach a share of the column overlap, of the title overlap or
   of the cosine; each target splits its floor between them where that reads fewest
   postings and vectors. Only the rarest columns and words those shares require are joined
   on, pairs that share too few of them are dropped by count, and a vector visits only the
   cells whose angle bound can still reach its share,
3. what is left is scored exactly and cut to the k best, one per series.

Both cuts are safe: no pair among the k best is lost, however low its score. Heavy
columns are spread over salted buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.scores import (
    DEFAULT_WEIGHTS,
    Weights,
    explain_match,
    norm,
    temporal_compat,
    weighted_score,
)
from shelfmark.functions.text import words
from shelfmark.functions.values import truthy
from shelfmark.operators.groups import attach_counts, skew_join
from shelfmark.operators.rank import diversify, topk_per_key
from shelfmark.operators.setjoin import EPS
from shelfmark.operators.vectors import TIE_DIGITS, matrix, vector_reach, vector_topk
from shelfmark.plans.dense import best_in_blocks, with_column_vectors
from shelfmark.plans.meet import best_of_scope
from shelfmark.session import BROADCAST_BYTES, durable

SCOPES = ("global", "category", "organization")
# First look: this many of a target's rarest tokens, and neighbours per token.
PROBE_TOKENS = 8
PROBE_ROWS = 16
# Rows of one token in one salted bucket.
SALT_ROWS = 20_000
# Pairs of one candidate that meet in one task when its record is attached.
PAIR_ROWS = 200_000
# Shares of a floor that may be asked of the cosine, and what their cost is guessed from:
# cosines with this many records by hash of the id, counted at this many levels.
EMBED_SHARES = (0.3, 0.5, 0.7, 0.85, 1.0)
SAMPLE, LEVELS = 512, 32
# Cosines are compared at TIE_DIGITS digits, so this is the smallest one above zero.
LEAST = 10.0**-TIE_DIGITS


@dataclass(frozen=True)
class Options:
    k: int = 5
    weights: Weights = DEFAULT_WEIGHTS
    # Datasets without an organisation count as one organisation.
    match_null_org: bool = True
    # Titles that normalise to nothing: one series for all of them, or one for each.
    collapse_empty: bool = False


def frame(records: DataFrame, options: Options = Options()) -> DataFrame:
    """The fields scoring needs, written once. Records keep one row per id."""
    own = F.concat(F.lit("\u0001"), F.col("id").cast("string"))
    series = F.col("series_key")
    if not options.collapse_empty:
        series = F.coalesce(truthy("series_key"), own)
    org = F.col("organization_id").cast("string")
    if options.match_null_org:
        org = F.coalesce(org, F.lit("\u0001"))
    extra = []
    if options.weights.embedding:
        if "vector" not in records.columns:
            raise ValueError("weights with an embedding part need a vector column")
        v = F.col("vector").cast("array<double>")
        length = norm(v)
        unit = F.transform(v, lambda c: c / length)
        there = (F.size(v) > 0) & (length > 0)
        extra = [F.when(there, unit).alias("unit"), F.when(there, F.col("vector")).alias("vector")]
    return durable(
        records.select(
            "id",
            "title",
            series.alias("series"),
            F.coalesce("category_slugs", F.array().cast("array<string>")).alias("categories"),
            org.alias("org"),
            truthy(F.col("organization_id").cast("string")).alias("known_org"),
            truthy("frequency").alias("frequency"),
            F.coalesce("covered", F.lit(False)).alias("covered"),
            F.array_distinct("columns").alias("columns"),
            F.array_distinct("columns").alias("tokens"),
            words("series_key").alias("title_words"),
            *extra,
        )
    )


def scope_keys(scope: str) -> Column:
    if scope == "global":
        return F.array(F.lit("*"))
    if scope == "category":
        return F.col("categories")
    if scope == "organization":
        return F.array_compact(F.array("org"))
    raise ValueError(f"unknown scope {scope!r}")


@dataclass(frozen=True)
class ColumnMatches:
    """Which columns mean the same.

    Columns with equal vectors share one representative, so that many copies of a column
    do not make a pair each. ``names`` holds (name, rep) of every column with a vector,
    ``looks`` one row per match of a representative: rep, b, sim (itself included).
    """

    names: DataFrame
    looks: DataFrame


def column_matches(names: DataFrame, pairs: DataFrame) -> ColumnMatches:
    """From (name, rep) and the (a, b, sim) of representatives, in either direction."""
    both = pairs.select("a", "b", "sim").unionByName(
        pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")
    )
    looks = both.groupBy(F.col("a").alias("rep"), "b").agg(F.max("sim").alias("sim"))
    return ColumnMatches(durable(names.select("name", "rep")), durable(looks))


@dataclass(frozen=True)
class ColumnVectors:
    """Columns by their vectors (name, vector): two match from a cosine of ``threshold`` on.

    For thresholds that a large share of all pairs of columns reaches: no match is listed, and
    all records of a scope are compared (see ``plans.dense``).
    """

    names: DataFrame
    threshold: float


@dataclass(frozen=True)
class Linked:
    """Columns of the records by what they mean: ``entries`` (id, name, rep) and ``looks``."""

    entries: DataFrame
    looks: DataFrame


def with_matches(recs: DataFrame, matches: ColumnMatches | None) -> tuple[DataFrame, Linked | None]:
    """Put representatives in ``tokens``; the columns with their representatives are rows."""
    if matches is None:
        return recs, None
    entries = durable(recs.select("id", F.explode("columns").alias("name")))
    named = durable(skew_join(entries, matches.names, ["name"]))
    tokens = named.groupBy("id").agg(F.collect_set("rep").alias("tokens"))
    nothing = F.array().cast("array<string>")
    out = recs.drop("tokens").join(tokens, "id", "left").withColumn("tokens", F.coalesce("tokens", nothing))
    return durable(out), Linked(named, matches.looks)


def _matched(pairs: DataFrame, linked: Linked) -> DataFrame:
    """Per pair the sum, over the target's columns, of the best match among the candidate's.

    Columns of either side meet as rows, (target's column, candidate's representative), and
    find their similarity in the table of matches; then the best per column, then the sum.
    """
    x = linked.entries.select(F.col("id").alias("target_id"), "name", "rep")
    y = linked.entries.select("id", F.col("rep").alias("b")).distinct()
    met = skew_join(pairs.select("target_id", "id"), y, ["id"], salt_rows=PAIR_ROWS).join(x, "target_id")
    return (
        skew_join(durable(met), linked.looks, ["rep", "b"])
        .groupBy("target_id", "id", "name")
        .agg(F.max("sim").alias("sim"))
        .groupBy("target_id", "id")
        .agg(F.sum("sim").alias("matched"))
    )


def _title_score() -> Column:
    shared = F.size(F.array_intersect("x.title_words", "y.title_words"))
    either = F.size("x.title_words") + F.size("y.title_words") - shared
    return F.when(either > 0, shared / either).otherwise(F.lit(0.0))


def _held(fields: DataFrame) -> int:
    """About how many bytes the records take in memory."""
    arrays = [c for c, kind in fields.dtypes if kind == "array<string>"]
    texts = [c for c, kind in fields.dtypes if kind == "string"]
    each = F.lit(64)
    for c in arrays:
        each = each + F.coalesce(F.octet_length(F.concat_ws("", c)) + 24 * F.size(c), F.lit(0))
    for c in texts:
        each = each + F.coalesce(F.octet_length(c), F.lit(0))
    if "unit" in fields.columns:
        each = each + F.coalesce(8 * F.size("unit"), F.lit(0))
    return fields.agg(F.coalesce(F.sum(each), F.lit(0))).first()[0]


def score_pairs(
    pairs: DataFrame,
    recs: DataFrame,
    weights: Weights,
    linked: Linked | None = None,
    floors: DataFrame | None = None,
) -> DataFrame:
    """Scores of (target_id, id) pairs: the parts that have a weight, and the sum.

    Only the fields that are compared go to the pairs. Records of a checked size are sent to
    every task and the pairs stay in place. Beyond that a few candidates may be paired with
    every target (the first of a scope, or neighbours on a frequent word), so their pairs are
    dealt into parts before records are attached. With ``floors`` (target_id, floor, last) pairs
    that come after that score and id are dropped as they are scored. A cosine below zero, or of a
    record without a vector, counts as zero.
    """
    pairs = durable(pairs)
    compared = ["series", "columns", "title_words", "frequency", "covered", *(["unit"] if weights.embedding else [])]
    fields = recs.select("id", *compared)
    in_place = _held(fields) <= BROADCAST_BYTES
    largest = F.greatest(F.size("x.columns"), F.size("y.columns"))
    matched = F.size(F.array_intersect("x.columns", "y.columns")).cast("double")
    if linked is not None:
        matched = F.coalesce("p.matched", F.lit(0.0))
    y = fields.select("id", F.struct(*compared).alias("y"))
    met = pairs.join(F.broadcast(y), "id") if in_place else skew_join(pairs, y, ["id"], salt_rows=PAIR_ROWS)
    x = fields.drop("series")
    if floors is not None:
        x = x.join(floors.withColumnRenamed("target_id", "id"), "id", "left")
    if in_place:
        x = F.broadcast(x)
    if linked is not None:
        met = met.join(_matched(pairs, linked), ["target_id", "id"], "left")
    parts = {
        "column_overlap": F.when(largest > 0, matched / largest).otherwise(F.lit(0.0)),
        "title_similarity": _title_score(),
        "temporal_compatibility": temporal_compat(
            F.col("x.frequency"), F.col("x.covered"), F.col("y.frequency"), F.col("y.covered")
        ),
    }
    embedding = None
    if weights.embedding:
        products = F.zip_with("x.unit", "y.unit", lambda a, b: a * b)
        near = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
        near = F.greatest(F.round(near, TIE_DIGITS), F.lit(0.0))
        parts["embedding_similarity"] = F.coalesce(near, F.lit(0.0))
        embedding = F.col("embedding_similarity")
    scored = (
        met.alias("p")
        .join(x.alias("x"), F.col("p.target_id") == F.col("x.id"))
        .select(*[f"p.{c}" for c in pairs.columns], F.col("y.series").alias("series"),
                *[v.alias(k) for k, v in parts.items()],
                *(["x.floor", "x.last"] if floors is not None else []))
    )
    total = weighted_score(
        F.col("column_overlap"), F.col("title_similarity"), F.col("temporal_compatibility"), weights, embedding
    )
    scored = scored.withColumn("score", total)
    if floors is None:
        return scored
    open_ = F.col("last").isNull() | (F.col("score") > F.col("floor"))
    return scored.where(open_ | ((F.col("score") == F.col("floor")) & (F.col("id") < F.col("last")))).drop("floor", "last")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("id").asc()]


def _fillers(scoped: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """Candidates for targets with too few real matches: (target_id, id).

    A pair that shares nothing scores by frequency and coverage only. For every such class
    of a scope the first 2k+1 series, with their two smallest ids, hold what any target of
    that scope can still need.
    """
    tags = [
        F.lit("*"),
        F.when(F.col("covered"), F.lit("c")),
        F.concat(F.lit("f"), F.col("frequency")),
        F.when(F.col("covered"), F.concat(F.lit("cf"), F.col("frequency"))),
    ]
    tag = F.explode(F.array_compact(F.array(*tags))).alias("tag")
    tagged = scoped.select("scope_key", "series", "id", tag)
    per_series = topk_per_key(tagged, ["scope_key", "tag", "series"], [F.col("id").asc()], 2, "_r")
    firsts = topk_per_key(
        per_series.where(F.col("_r") == 1).drop("_r"), ["scope_key", "tag"], [F.col("id").asc()], 2 * k + 1, "_s"
    ).select("scope_key", "tag", "series")
    heads = per_series.join(firsts, ["scope_key", "tag", "series"]).select("scope_key", "tag", "id")
    wanted = targets.select("scope_key", F.col("id").alias("target_id"), tag)
    return wanted.join(heads, ["scope_key", "tag"]).select("target_id", "id")


def _postings(scoped: DataFrame, tokens: str, size: Column) -> DataFrame:
    """Tokens of every record in its scope, with the number of records that hold them."""
    rows = scoped.select("scope_key", "id", size.alias("n"), F.explode(tokens).alias("token"))
    return durable(attach_counts(rows, ["scope_key", "token"], count="f"))


def _asked(postings: DataFrame, targets: DataFrame) -> DataFrame:
    """What each target looks for, one row per own token that others hold too.

    scope_key, target_id, n, own, rep (the token itself), weight (records that hold it).
    """
    mine = postings.join(targets.select("scope_key", "id"), ["scope_key", "id"], "left_semi")
    return mine.where(F.col("f") > 1).select(
        "scope_key",
        F.col("id").alias("target_id"),
        "n",
        F.col("token").alias("own"),
        F.col("token").alias("rep"),
        F.col("f").alias("weight"),
    )


def _asked_by_vector(postings: DataFrame, targets: DataFrame, linked: Linked) -> tuple[DataFrame, DataFrame]:
    """The same for columns that match by vector, and what each representative looks for.

    The second table has a row per token that a representative matches in a scope:
    scope_key, rep, token, f (records that hold it); the weight is the sum of those.
    """
    counts = postings.select("scope_key", "token", "f").distinct()
    looks = durable(
        linked.looks.select("rep", F.col("b").alias("token")).join(counts, "token").select("scope_key", "rep", "token", "f")
    )
    weights = looks.groupBy("scope_key", "rep").agg(F.sum("f").alias("weight"))
    mine = durable(
        targets.select("scope_key", "id", F.size("columns").alias("n"))
        .join(linked.entries, "id")
        .select("scope_key", F.col("id").alias("target_id"), "n", F.col("name").alias("own"), "rep")
    )
    asked = skew_join(mine, weights, ["scope_key", "rep"])
    return durable(asked.select("scope_key", "target_id", "n", "own", "rep", "weight")), looks


def _probe(postings: DataFrame, asked: DataFrame, looks: DataFrame | None = None) -> DataFrame:
    """A few neighbours on each target's rarest shared tokens."""
    keys = ["scope_key", "token"]
    heads = topk_per_key(postings.select(*keys, "id"), keys, [F.col("id").asc()], PROBE_ROWS, "_r").drop("_r")
    if looks is None:
        tokens = asked.select("scope_key", "target_id", F.col("rep").alias("token"), F.col("weight").alias("f"))
    else:
        tokens = skew_join(asked.select("scope_key", "target_id", "rep"), looks.where("f > 1"), ["scope_key", "rep"])
    rare = topk_per_key(
        tokens.select("scope_key", "target_id", "token", "f").where(F.col("f") > 1),
        ["scope_key", "target_id"],
        [F.col("f").asc(), F.col("token").asc()],
        PROBE_TOKENS,
        "_r",
    )
    return rare.join(heads, keys).select("target_id", "id")


def _rare_first(asked: DataFrame, name: str) -> DataFrame:
    """One row per target of a scope: its own tokens, rare ones first, and their full number."""
    return asked.groupBy("scope_key", "target_id").agg(
        F.any_value("n").alias(f"n_{name}"),
        F.sort_array(F.collect_list(F.struct("weight", "own", "rep"))).alias(f"o_{name}"),
    )


def _with_vectors(scoped: DataFrame, *more: str) -> DataFrame:
    return scoped.where("unit is not null").select("scope_key", "id", F.col("unit").alias("vector"), *more)


def _vector_probe(scoped: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """The nearest records by vector, one per series: with k series at hand the floor is real."""
    hits = vector_topk(
        _with_vectors(targets), _with_vectors(scoped, "series"), k,
        drop_self=True, within="scope_key", one_per="series",
    )
    return hits.select(F.col("query_id").alias("target_id"), "id")


def _vector_costs(scoped: DataFrame, targets: DataFrame) -> DataFrame:
    """scope_key, target_id and ``reads``: about how many vectors of the scope lie at each level.

    Level i counts cosines of i / LEVELS or more, by the cosines with a sample of records
    (``SAMPLE`` at most, by hash of the id). It only steers what is read, never what counts.
    """
    scoped_vectors = durable(_with_vectors(scoped))
    few = (
        scoped_vectors.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    )
    sample = matrix(few.column("vector"))
    wanted = targets.where("unit is not null").select("scope_key", F.col("id").alias("target_id"), "unit")
    kind = wanted.schema["target_id"].dataType.simpleString()

    def count(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            near = matrix(batch.column(2)) @ sample.T
            level = np.clip(np.floor(near * LEVELS + 1e-6), -1, LEVELS).astype(int)
            held = np.zeros((len(level), LEVELS + 2))
            np.add.at(held, (np.arange(len(level))[:, None], level + 1), 1.0 / max(1, level.shape[1]))
            above = held[:, ::-1].cumsum(axis=1)[:, ::-1][:, 1:]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(list(above), pa.list_(pa.float64()))],
                names=["scope_key", "target_id", "share"],
            )

    shares = wanted.mapInArrow(count, f"scope_key string, target_id {kind}, share array<double>")
    sizes = scoped_vectors.groupBy("scope_key").agg(F.count(F.lit(1)).alias("size"))
    return skew_join(durable(shares), sizes, ["scope_key"]).select(
        "scope_key", "target_id", F.transform("share", lambda x: x * F.col("size")).alias("reads")
    )


def _vector_reach(scoped: DataFrame, targets: DataFrame, bounds: DataFrame) -> DataFrame:
    """(target_id, id) of every pair whose cosine can reach the target's share."""
    asked = bounds.where("reads is not null").select(
        "scope_key",
        F.col("target_id").alias("id"),
        F.greatest(F.col("split.embedding") - 1e-7, F.lit(LEAST)).alias("floor"),
    )
    queries = durable(_with_vectors(targets).join(asked, ["scope_key", "id"]))
    hits = vector_reach(queries, _with_vectors(scoped), "floor", within="scope_key")
    return hits.where(F.col("query_id") != F.col("id")).select(F.col("query_id").alias("target_id"), "id")


def _prefix_length(share: Column, n: Column, o: Column) -> Column:
    """How many of the rarest tokens must be looked at to meet every overlap >= share.

    Such a pair matches at least share * n of the n tokens, so it matches one of the first
    n - ceil(share * n) + 1 in any order; tokens nobody else holds are not in ``o``.
    """
    need = F.greatest(F.ceil(share * n - EPS), F.lit(1))
    return F.greatest(F.lit(0), F.size(o) - need + 1).cast("int")


def _splits(excess: Column, w: Weights) -> list[tuple[Column, Column]]:
    """Ways to say: a pair with this much from columns and title has (columns >= a or title >= b)."""
    zero, never = F.lit(0.0), F.lit(2.0)
    if not w.title:
        return [(F.greatest(excess / w.columns, zero), never)]
    if not w.columns:
        return [(never, F.greatest(excess / w.title, zero))]
    out = []
    for f in (0.3, 0.5, 0.6, 0.7, 0.8, 0.9):
        out.append((F.greatest(excess * f / w.columns, zero), F.greatest(excess * (1 - f) / w.title, zero)))
    # Even equal columns are not enough without the title, and the other way round.
    out.append((F.when(excess > w.columns, never).otherwise(zero), F.greatest((excess - w.columns) / w.title, zero)))
    out.append((F.greatest((excess - w.title) / w.columns, zero), F.when(excess > w.title, never).otherwise(zero)))
    return out


def _bounds(
    by_column: DataFrame, by_word: DataFrame, floors: DataFrame, w: Weights, by_vector: DataFrame | None = None
) -> DataFrame:
    """Per target and scope the cheapest split of its floor, with both sides' tokens.

    The cost of a split is the number of postings its prefixes would read, and of vectors
    that reach its cosine, so a target avoids its frequent columns and words, and cosines
    that many records have, wherever the floor lets it. Without a vector the cosine is zero
    and the floor is split between columns and title alone.
    """
    no_tokens = F.array().cast(by_word.schema["o_word"].dataType)
    keys = ["scope_key", "target_id"]
    both = by_column.join(by_word, keys, "full_outer")
    if by_vector is not None:
        both = both.join(by_vector, keys, "full_outer")
    both = (
        both.join(floors, "target_id")
        .withColumn("n_column", F.coalesce("n_column", F.lit(0)))
        .withColumn("n_word", F.coalesce("n_word", F.lit(0)))
        .withColumn("o_column", F.coalesce("o_column", no_tokens))
        .withColumn("o_word", F.coalesce("o_word", no_tokens))
    )

    def cost(share: Column, side: str) -> Column:
        head = F.slice(f"o_{side}", F.lit(1), _prefix_length(share, F.col(f"n_{side}"), F.col(f"o_{side}")))
        return F.aggregate(head, F.lit(0).cast("bigint"), lambda acc, e: acc + e["weight"])

    excess = F.col("excess")
    if by_vector is None:
        options = [
            F.struct((cost(a, "column") + cost(b, "word")).alias("cost"), a.alias("column"), b.alias("word"))
            for a, b in _splits(excess, w)
        ]
        return durable(both.withColumn("split", F.array_min(F.array(*options))).drop("excess"))
    options = []
    for share in EMBED_SHARES:
        # no cosine is above one, so no more than its weight can be asked of it
        part = F.greatest(F.least(excess * share, F.lit(w.embedding)), F.lit(0.0))
        part = F.when(F.col("reads").isNotNull(), part).otherwise(F.lit(0.0))
        floor = part / w.embedding
        level = F.floor(floor * LEVELS).cast("int")
        reads = F.coalesce(F.element_at("reads", level + 1), F.lit(0.0))
        for a, b in _splits(excess - part, w) if w.columns or w.title else [(F.lit(2.0), F.lit(2.0))]:
            total = cost(a, "column") + cost(b, "word") + reads
            options.append(
                F.struct(total.alias("cost"), a.alias("column"), b.alias("word"), floor.alias("embedding"))
            )
    return durable(both.withColumn("split", F.array_min(F.array(*options))).drop("excess"))


def _reach(postings: DataFrame, bounds: DataFrame, side: str, looks: DataFrame | None = None) -> DataFrame:
    """(target_id, id) of every pair whose overlap on one side can reach the target's share.

    Equal tokens match one to one; similar columns (``looks``) need not, several of the
    target's may match the same one, so the other side's size says nothing then.
    """
    o, share = F.col(f"o_{side}"), F.col("share")
    first = _prefix_length(share, F.col("n"), o)
    keep = ["scope_key", "target_id", "n", "share", "behind"]
    prefix = (
        bounds.withColumn("share", F.col("split")[side])
        .withColumn("n", F.col(f"n_{side}"))
        .withColumn("behind", F.size(o) - first)
        .select(*keep, F.explode(F.slice(o, F.lit(1), first)).alias("e"))
        .select(*keep, F.col("e.rep").alias("rep"), F.col("e.weight").alias("f"))
    )
    if looks is None:
        prefix = prefix.withColumnRenamed("rep", "token")
    else:
        prefix = skew_join(durable(prefix.drop("f")), looks, ["scope_key", "rep"]).drop("rep")
    # A heavy token becomes a square of buckets, each side spread over one of its edges.
    edge = F.ceil(F.col("f") / F.lit(SALT_ROWS)).cast("bigint")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), edge - 1))
    left = (
        prefix.withColumn("row_salt", F.pmod(F.xxhash64("target_id"), edge))
        .withColumn("salt", every)
        .drop("f")
    )
    right = postings.select(
        "scope_key",
        "token",
        "id",
        F.col("n").alias("m"),
        F.pmod(F.xxhash64("id"), edge).alias("salt"),
        every.alias("row_salt"),
    )
    largest = F.greatest("n", "m")
    most = F.least("n", "m") if looks is None else F.col("n")
    near = (most >= largest * share - EPS) & (F.col("target_id") != F.col("id"))
    wanted = largest * share
    if side == "word":
        # Title overlap is a Jaccard index: shared / (n + m - shared).
        wanted = (F.col("n") + F.col("m")) * share / (share + 1)
    return (
        left.join(right, ["scope_key", "token", "salt", "row_salt"])
        .where(near)
        .groupBy("scope_key", "target_id", "id")
        .agg(F.count(F.lit(1)).alias("seen"), F.max(wanted - F.col("behind")).alias("wanted"))
        .where(F.col("seen") >= F.col("wanted") - EPS)
        .select("target_id", "id")
    )


def similar_in_scope(
    recs: DataFrame,
    scope: str,
    options: Options = Options(),
    linked: Linked | None = None,
    targets: DataFrame | None = None,
) -> DataFrame:
    """The k best of one scope for each target: target_id, id, rank, scores.

    ``recs`` and ``linked`` come from :func:`frame` and :func:`with_matches`.
    """
    k, w = options.k, options.weights
    scoped = recs.withColumn("scope_key", F.explode(scope_keys(scope)))
    chosen = scoped
    if targets is not None:
        chosen = scoped.join(targets.select("id").distinct(), "id", "left_semi")
    if linked is None:
        # What each task has found is kept, since results may be read more than once.
        found = durable(best_of_scope(scoped, chosen, w, k))
        best = diversify(found, ["target_id"], "series", _order(), k)
        return best.withColumn("scope", F.lit(scope)).drop("series")

    by_column = _postings(scoped, "tokens", F.size("columns"))
    by_word = _postings(scoped, "title_words", F.size("title_words"))
    looks = None
    if linked is None:
        wanted_columns = _asked(by_column, chosen)
    else:
        wanted_columns, looks = _asked_by_vector(by_column, chosen, linked)
    wanted_words = _asked(by_word, chosen)

    at_hand = _fillers(scoped, chosen, k)
    at_hand = at_hand.unionByName(_probe(by_column, wanted_columns, looks))
    at_hand = at_hand.unionByName(_probe(by_word, wanted_words))
    if w.embedding:
        at_hand = at_hand.unionByName(_vector_probe(scoped, chosen, k))
    at_hand = at_hand.where(F.col("target_id") != F.col("id")).distinct()
    first = durable(score_pairs(at_hand, recs, w, linked))

    # The k best of these stand for all of them: what is not among them is behind k series.
    ahead = durable(diversify(first, ["target_id"], "series", _order(), k).drop("rank"))
    kth = durable(
        ahead.groupBy("target_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct((-F.col("score")).alias("s"), "id")).alias("last"))
        .select(
            "target_id",
            F.when(F.col("n") >= k, -F.col("last.s")).otherwise(0.0).alias("floor"),
            F.when(F.col("n") >= k, F.col("last.id")).alias("last"),
        )
    )
    # What a pair must bring from columns and title to reach the floor with the full time part.
    bonus = (F.col("frequency").isNotNull().cast("int") + F.col("covered").cast("int")) * 0.5
    excess = F.coalesce("floor", F.lit(0.0)) - EPS - bonus * w.temporal
    floors = (
        chosen.select(F.col("id").alias("target_id"), "frequency", "covered")
        .distinct()
        .join(kth.drop("last"), "target_id", "left")
        .select("target_id", excess.alias("excess"))
    )
    bounds = _bounds(
        _rare_first(wanted_columns, "column"), _rare_first(wanted_words, "word"), floors, w,
        _vector_costs(scoped, chosen) if w.embedding else None,
    )
    found = _reach(by_column, bounds, "column", looks).unionByName(_reach(by_word, bounds, "word"))
    if w.embedding:
        found = found.unionByName(_vector_reach(scoped, chosen, bounds))
    new = found.distinct().join(first.select("target_id", "id"), ["target_id", "id"], "left_anti")
    scored = ahead.unionByName(score_pairs(new, recs, w, linked, kth))
    best = diversify(scored, ["target_id"], "series", _order(), k)
    return best.withColumn("scope", F.lit(scope)).drop("series")


def _similar_in_blocks(
    recs: DataFrame, scope: str, options: Options, matches: ColumnVectors, targets: DataFrame | None
) -> DataFrame:
    """:func:`similar_in_scope` for records with ``vectors``, by comparing all of a scope."""
    scoped = recs.withColumn("scope_key", F.explode(scope_keys(scope)))
    chosen = scoped if targets is None else scoped.join(targets.select("id").distinct(), "id", "left_semi")
    found = best_in_blocks(scoped, chosen, options.weights, matches.threshold, options.k)
    best = diversify(found, ["target_id"], "series", _order(), options.k)
    return best.withColumn("scope", F.lit(scope)).drop("series")


def present(best: DataFrame, recs: DataFrame, reason: str | None = None) -> DataFrame:
    """Result rows as shown: titles, rounded scores, shared columns, reason."""
    x = recs.select(
        F.col("id").alias("target_id"),
        F.col("title").alias("target_title"),
        F.col("columns").alias("xc"),
        F.col("categories").alias("xk"),
        F.col("known_org").alias("xo"),
    )
    y = recs.select(
        "id",
        "title",
        F.col("columns").alias("yc"),
        F.col("categories").alias("yk"),
        F.col("known_org").alias("yo"),
    )
    shared = F.array_sort(F.array_intersect("xc", "yc"))
    why = (
        F.lit(reason)
        if reason
        else explain_match(
            F.col("shared_columns"),
            F.arrays_overlap("xk", "yk"),
            F.coalesce(F.col("xo") == F.col("yo"), F.lit(False)),
        )
    )
    rounded = [
        F.round(c, 4).alias(c)
        for c in (
            "score", "column_overlap", "title_similarity", "temporal_compatibility", "embedding_similarity"
        )
        if c in best.columns
    ]
    return (
        best.join(x, "target_id")
        .join(y, "id")
        .withColumn("shared_columns", shared)
        .withColumn("reason", why)
        .select(
            "scope", "target_id", "target_title", "rank", F.col("id").alias("dataset_id"), "title", *rounded,
            "shared_columns", "reason",
        )
    )


def similar_datasets(
    records: DataFrame,
    options: Options = Options(),
    scopes: tuple[str, ...] = SCOPES,
    matches: ColumnMatches | ColumnVectors | None = None,
    targets: DataFrame | None = None,
) -> DataFrame:
    """Global, category and organisation lists for all datasets, or for ``targets`` (id).

    ``matches`` says which columns mean the same by their vectors (see
    ``search.column_similarity``, or ``search.column_vectors`` where most columns match);
    without it columns match by equal names. Weights with an
    embedding part (``PLANNED_WEIGHTS``) need a ``vector`` column in the records, all vectors
    of one length; a null or zero vector has a cosine of zero with every other, and a
    negative cosine counts as zero.
    """
    if isinstance(matches, ColumnVectors):
        recs = with_column_vectors(frame(records, options), matches.names)
    else:
        recs, linked = with_matches(frame(records, options), matches)
    best = None
    for scope in scopes:
        if isinstance(matches, ColumnVectors):
            part = _similar_in_blocks(recs, scope, options, matches, targets)
        else:
            part = similar_in_scope(recs, scope, options, linked, targets)
        best = part if best is None else best.unionByName(part)
    return present(best, recs)


def rerank_candidates(
    candidates: DataFrame,
    records: DataFrame,
    options: Options = Options(),
    scopes: tuple[str, ...] = SCOPES,
    matches: ColumnMatches | None = None,
) -> DataFrame:
    """Score a candidate pool (target_id, id), such as the hits of a vector search, by scope."""
    recs, linked = with_matches(frame(records, options), matches)
    pool = candidates.select("target_id", "id").where(F.col("target_id") != F.col("id")).distinct()
    scored = durable(score_pairs(pool, recs, options.weights, linked))
    best = None
    for scope in scopes:
        part = diversify(in_scope(scored, recs, scope), ["target_id"], "series", _order(), options.k)
        part = part.withColumn("scope", F.lit(scope)).drop("series")
        best = part if best is None else best.unionByName(part)
    return present(best, recs)


def in_scope(pairs: DataFrame, recs: DataFrame, scope: str) -> DataFrame:
    """Pairs whose two datasets share the scope."""
    if scope == "global":
        return pairs
    keys = recs.select("id", scope_keys(scope).alias("k"))
    return (
        pairs.join(keys.select(F.col("id").alias("target_id"), F.col("k").alias("xk")), "target_id")
        .join(keys.select("id", F.col("k").alias("yk")), "id")
        .where(F.arrays_overlap("xk", "yk"))
        .drop("xk", "yk")
    )

