"""Per-key counts and joins that hold up when one key has most rows, and lists per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that meet in one task; a key with more is dealt into salted parts.
SALT_ROWS = 1_000_000


def skew_join(
    big: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Join ``big`` with a table that holds each key once, whatever the keys' weights.

    A key of more than ``salt_rows`` rows is dealt into parts of about that size, and its
    partner is repeated for each part. So the repeated rows are at most one for every
    ``salt_rows`` rows of ``big``, however wide they are, and nothing is broadcast that Spark
    does not find small itself. ``counts`` (keys, rows) saves the counting. ``big`` is read
    twice, so hand in a scan or a durable table. For ``how="left"`` rows whose key holds a
    NULL are kept without a partner.
    """
    keys = list(keys)
    if counts is None:
        counts = big.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col(counts.columns[len(keys)])
    heavy = counts.where(n > salt_rows).select(*keys, F.ceil(n / F.lit(salt_rows)).cast("int").alias("_k"))
    parts = F.coalesce("_k", F.lit(1))
    dealt = (
        big.withColumn("_row", F.monotonically_increasing_id())
        .join(heavy, keys, "left")
        .withColumn("_part", F.pmod(F.xxhash64("_row"), parts).cast("int"))
        .drop("_k", "_row")
    )
    repeated = (
        small.join(heavy, keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_k")
    )
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")


def attach_counts(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Sequence[Column] = (),
    count: str = "n",
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """Add the number of rows (and other aggregates) of a row's key to every row.

    The counts are pre-aggregated on the map side; see :func:`skew_join` for heavy keys.
    Rows whose key holds a NULL are dropped.
    """
    keys = list(keys)
    df = df.dropna(subset=keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), *aggs)
    return skew_join(df, counts, keys, counts=counts.select(*keys, count), salt_rows=salt_rows)


def sorted_lists(df: DataFrame, key: str, entry: Column, out: str) -> DataFrame:
    """One sorted list of ``entry`` per key: key, ``n_rows``, the list.

    One scan and one shuffle. A list is one value, so a key's entries meet in one task in
    the end; where they may be many, keep them as rows instead.
    """
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list(entry)).alias(out)
    )


def id_lists(df: DataFrame, key: str, id_col: str, ids: str = "ids") -> DataFrame:
    """The sorted ids of each key in one list: key, n_ids, ids."""
    lists = sorted_lists(df.dropna(subset=[key]), key, F.col(id_col), ids)
    return lists.withColumnRenamed("n_rows", "n_ids")
