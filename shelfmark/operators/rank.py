"""Ranking, de-duplication and paging.

Every ranking takes a full ordering, tie-break included, so results do not depend on
file order. Row numbers that are compared with a constant let Spark cut each map
partition down to k rows per key before the shuffle (WindowGroupLimit), so one heavy key
never reaches a single task whole.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import durable

# The largest page a catalogue listing and a row preview may ask for.
MAX_PAGE = 10_000
MAX_PREVIEW_PAGE = 200

# Listing order -> column, all descending.
SORT_COLUMNS = {
    "NEWEST": "created_at",
    "RECENTLY_UPDATED": "updated_at",
    "MOST_DOWNLOADED": "download_count",
    "MOST_POPULAR": "views_count",
    "MOST_RELEVANT": "relevance",
}

# Beyond this many rows a sorted prefix is numbered in place instead of being held by one task.
PREFIX_ROWS = 20_000


def topk_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return topk_per_key(df, keys, order, 1, "_first").drop("_first")


def last_wins(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The latest row of each key by ``order``."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_wins(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The earliest row of each key by ``order``."""
    return first_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def diversify(
    df: DataFrame,
    keys: Sequence[str],
    group: str,
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
) -> DataFrame:
    """Best row of each group, then the k best of those, for every key."""
    return topk_per_key(first_per_key(df, [*keys, group], order), keys, order, k, rank)


def landing_order(df: DataFrame) -> Column:
    """Position of a row as it landed: file name, block of the file, row within it.

    Spark packs files into tasks by size, so a row number alone doesn't follow their names.
    Rows that come from no file are ordered as the table lists them.
    """
    row = F.monotonically_increasing_id().alias("row")
    log = logging.getLogger("DataFrameQueryContextLogger")
    muted, log.disabled = log.disabled, True  # not resolving is an answer here
    try:
        df.select("_metadata.file_path")
    except AnalysisException:
        return F.struct(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("block"), row)
    finally:
        log.disabled = muted
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return F.struct(file.alias("file"), block.alias("block"), row)


def running_total(
    df: DataFrame, order: Sequence[Column], value: Column, out: str
) -> DataFrame:
    """Sum of ``value`` over all earlier rows of one total order, without a single-task sort.

    Rows are range partitioned and sorted, written once, summed per partition, and
    continued from the running total of those sums.
    """
    placed = durable(
        df.withColumn("_value", value).orderBy(*order).withColumn("_part", F.spark_partition_id())
    )
    # One row per sort partition, so this window sees a few thousand rows at most.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.sum("_value").alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    )
    inside = (
        Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .drop("_part", "_value", "_start")
    )


def global_rank(df: DataFrame, order: Sequence[Column], rank: str = "rank") -> DataFrame:
    """1-based position of every row in one total order."""
    return running_total(df, order, F.lit(1).cast("bigint"), rank).withColumn(rank, F.col(rank) + 1)


def first_rows(df: DataFrame, order: Sequence[Column], n: int, offset: int = 0) -> DataFrame:
    """Rows offset+1 .. offset+n of a total order."""
    if offset + n <= PREFIX_ROWS:
        return df.orderBy(*order).offset(offset).limit(n)
    ranked = global_rank(df, order, "_rank")
    page = ranked.where(F.col("_rank").between(offset + 1, offset + n))
    return page.orderBy("_rank").drop("_rank")


def paginate(
    df: DataFrame, order: Sequence[Column], page: int, size: int, max_size: int = MAX_PAGE
) -> DataFrame:
    """One 1-based page of a listing."""
    if page < 1 or not 0 <= size <= max_size:
        raise ValueError(f"page must be >= 1 and size between 0 and {max_size}")
    return first_rows(df, order, size, (page - 1) * size)


def page_envelope(df: DataFrame, page: int, size: int) -> DataFrame:
    """Total, page, size and number of pages of a listing, as one row."""
    total = F.count(F.lit(1))
    pages = F.ceil(total / F.lit(size)) if size else F.lit(0)
    return df.agg(
        total.alias("total"),
        F.lit(page).alias("page"),
        F.lit(size).alias("page_size"),
        pages.cast("bigint").alias("total_pages"),
    )


def number_pages(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """All pages at once: each row gets its page and its position on it."""
    ranked = global_rank(df, order, "_rank")
    zero_based = F.col("_rank") - 1
    return (
        ranked.withColumn("page", (F.floor(zero_based / size) + 1).cast("bigint"))
        .withColumn("position", (zero_based % size + 1).cast("bigint"))
        .drop("_rank")
    )


def catalog_order(sort_by: str = "MOST_RELEVANT", id_col: str = "id") -> list[Column]:
    if sort_by not in SORT_COLUMNS:
        raise ValueError(f"unknown sort order {sort_by!r}")
    return [F.col(SORT_COLUMNS[sort_by]).desc_nulls_last(), F.col(id_col).asc()]


def sort_catalog(df: DataFrame, sort_by: str, id_col: str = "id") -> DataFrame:
    return df.orderBy(*catalog_order(sort_by, id_col))


def pair_order(
    score: str = "jaccard_score", a: str = "dataset_a_id", b: str = "dataset_b_id"
) -> list[Column]:
    """Pairs are ordered by their rounded score, then by the two ids."""
    return [F.col(score).desc(), F.col(a).asc(), F.col(b).asc()]


def rank_pairs(df: DataFrame, **names: str) -> DataFrame:
    return df.orderBy(*pair_order(**names))


def sample_for_labels(pairs: DataFrame, n: int, same: str = "same_category", **names: str) -> DataFrame:
    """The n best cross-category pairs; when there is none at all, the n best pairs."""
    crossing = pairs.agg(F.coalesce(F.bool_or(~F.col(same)), F.lit(False))).scalar()
    kept = pairs.where(~F.col(same) | ~crossing)
    return first_rows(kept, pair_order(**names), n)


def sample_ids(df: DataFrame, id_col: str, n: int, seed: int) -> DataFrame:
    """n rows picked by a seeded hash of their id: the MD5 of ``seed:id``."""
    mixed = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return first_rows(df, [mixed, F.col(id_col)], n)


def score_threshold(df: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Keep scores of at least ``threshold``; zero or less means no threshold."""
    return df.where(F.col(score) >= threshold) if threshold > 0 else df


def display_rank(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return global_rank(df, order, "position")


def order_by_name(name: str, descending: bool, id_col: str) -> list[Column]:
    c = F.col(name)
    return [c.desc_nulls_last() if descending else c.asc_nulls_last(), F.col(id_col).asc()]
