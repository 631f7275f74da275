"""Sharding by extendible hashing: only buckets over the byte limit split on another bit."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.session import durable

# Bits of the hash: the first 15 hex digits of an MD5.
BITS = 60
# Depths beyond the even one that a pass looks at before it goes on with what is left.
AHEAD = 6


def hash_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 of the key's text; a null key hashes like an empty one."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def prefix(h: Column, depth: int) -> Column:
    return F.shiftright(h, BITS - depth)


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """Buckets over ``sizes`` (h, bytes, rows): ``prefix``, ``depth``, ``bytes``, ``rows``.

    Starts with one bucket of all and splits a bucket on the next bit of the hash only while
    it is over ``limit`` and holds more than one hash. Each pass adds up the prefixes of a
    range of depths in the cluster and keeps, for every path, the first that fits; what still
    does not fit goes on with deeper bits.
    """
    total = sizes.agg(F.sum("bytes").alias("b")).first().b or 0
    low, high = 0, min(BITS, AHEAD + max(0, math.ceil(math.log2(max(1, total / limit)))))
    left, done = sizes, None
    while True:
        sums = [
            F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
            F.min("h0").alias("h0"), F.max("h1").alias("h1"),
        ]
        # the deepest prefixes first: a number that follows the shards, not the rows
        leaves = (
            left.withColumns({"h0": F.col("h"), "h1": F.col("h"), "leaf": prefix(F.col("h"), high)})
            .groupBy("leaf")
            .agg(*sums)
        )
        buckets = (
            leaves.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
            .withColumn("prefix", F.expr(f"shiftright(leaf, {high} - depth)"))
            .groupBy("depth", "prefix")
            .agg(*sums)
        )
        fits = buckets.where((F.col("bytes") <= limit) | (F.col("h0") == F.col("h1")))
        fits = durable(fits)
        # a fitting bucket counts unless its parent, one bit shorter, fits as well
        parents = fits.select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        own = fits.withColumn("parent", F.shiftright("prefix", 1))
        first = own.join(parents, ["depth", "parent"], "left_anti").select(
            "depth", "prefix", "bytes", "rows"
        )
        done = first if done is None else done.union(first)
        if high == BITS:
            return durable(done)
        deepest = buckets.where(
            (F.col("depth") == high) & (F.col("bytes") > limit) & (F.col("h0") != F.col("h1"))
        ).select("prefix")
        deepest = durable(deepest)
        if not deepest.head(1):
            return durable(done)
        left = durable(left.withColumn("prefix", prefix(F.col("h"), high)).join(deepest, "prefix", "left_semi").drop("prefix"))
        low, high = high + 1, min(BITS, high + 2 * AHEAD)


def assign_shards(
    docs: DataFrame,
    limit: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A shard for every document so that no shard is over ``limit`` bytes of text.

    Returns id, ``shard`` (the bits of the hash prefix as a string, with the part if any),
    ``depth`` (number of bits), ``part`` and ``n_bytes`` (UTF-8 bytes of the text).

    A bucket that still is over the limit when all its rows have one hash (a document larger
    than the limit, or very many rows with one id) can't be split by bits. Its rows are dealt
    into numbered parts by running size over (text hash, row order), so that every part but one
    of a single oversized document fits. Null and empty texts have 0 bytes; a null id hashes
    like an empty one; repeated rows count as often as they occur; other columns are ignored;
    an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = durable(
        docs.select(
            F.col(id_col).alias("id"), hash_bits(F.col(id_col)).alias("h"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        )
    )
    sizes = durable(
        src.groupBy("h").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    )
    buckets = directory(sizes, limit)
    # every hash finds the bucket by one of the depths in use
    depths = [r.depth for r in buckets.select("depth").distinct().orderBy("depth").collect()]
    keys = F.array(*[F.struct(F.lit(d).alias("depth"), prefix(F.col("h"), d).alias("prefix")) for d in depths])
    placed = (
        sizes.select("h", F.explode(keys if depths else F.array().cast("array<struct<depth:int,prefix:bigint>>")).alias("k"))
        .select("h", "k.depth", "k.prefix")
        .join(buckets.select("depth", "prefix", F.col("bytes").alias("all_bytes")), ["depth", "prefix"])
    )
    rows = src.join(placed, "h")
    bits = F.when(F.col("depth") > 0, F.expr(f"right(lpad(bin(prefix), {BITS}, '0'), depth)")).otherwise("")
    fine = rows.where(F.col("all_bytes") <= limit).withColumn("part", F.lit(0).cast("bigint"))
    over = _parts(rows.where(F.col("all_bytes") > limit), limit)
    out = fine.unionByName(over).withColumn("bits", bits)
    name = F.when(F.col("part") > 0, F.concat_ws(".", "bits", F.col("part").cast("string"))).otherwise(F.col("bits"))
    return out.select(
        F.col("id").alias(id_col), name.alias("shard"), F.col("depth").cast("int").alias("depth"),
        "part", F.col("bytes").alias("n_bytes"),
    )


def _parts(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of unsplittable hashes in parts of at most ``limit`` bytes, unless one row is more.

    Rows of a hash and size are counted, not gathered: k rows of b bytes fill parts of
    floor(limit / b) rows each, numbered by size class; rows within a class are dealt by their
    position in a partition-wise count.
    """
    rows = durable(rows.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    classes = rows.groupBy("h", "bytes", "_p").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy("h", "bytes").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    starts = classes.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), F.col("bytes"))))
    whole = rows.groupBy("h", "bytes").agg(F.count(F.lit(1)).alias("_k")).withColumn("_parts", F.ceil(F.col("_k") / per))
    order = Window.partitionBy("h").orderBy("bytes").rowsBetween(Window.unboundedPreceding, -1)
    base = whole.withColumn("_base", F.coalesce(F.sum("_parts").over(order), F.lit(0))).select("h", "bytes", "_base")
    place = Window.partitionBy("h", "bytes", "_p").orderBy("_i")
    return (
        rows.withColumn("_r", F.row_number().over(place) - 1)
        .join(starts.drop("_n"), ["h", "bytes", "_p"])
        .join(base, ["h", "bytes"])
        .withColumn("part", (F.col("_base") + F.floor((F.col("_before") + F.col("_r")) / per)).cast("bigint"))
        .drop("_p", "_i", "_r", "_before", "_base")
    )
