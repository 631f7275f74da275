"""Pieces several operators share: sorted groups in Arrow streams, hot buckets in blocks,
and connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import durable

# Most members of one bucket that meet in one task at a time, on each side.
BLOCK_ROWS = 512


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys in batches that are sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.concatenate(([0], np.flatnonzero(change), [batch.num_rows]))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            key = tuple(c[a] for c in columns)
            if held_key is not None and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(a, b - a))
    if held_key is not None:
        yield held_key, pa.Table.from_batches(held)


def map_buckets(
    rows: DataFrame,
    bucket: str,
    member: str,
    fn: Callable[[int, pa.Table, pa.Table | None], dict | None],
    schema: str,
    block_rows: int = BLOCK_ROWS,
    *,
    payload: DataFrame | None = None,
) -> DataFrame:
    """Call ``fn(bucket, left, right)`` so that every two members of a bucket meet once.

    ``rows`` holds a bucket id and a member id (both long) with any other columns; ``payload``
    one row per member (by all columns the two share) with the wide ones, which are attached
    only where a member meets another. Buckets of one member are left out. A bucket of up to
    ``block_rows`` members is one call with ``right`` None. A larger one is dealt into slices
    by a hash of the member, and each pair of slices is a call of its own in its own task, so
    no task holds a bucket whole and none is cut.
    ``fn`` returns columns as a dict of arrays, or None.
    """
    counts = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    k = F.ceil(F.col("_m") / F.lit(block_rows)).cast("int")
    dealt = (
        rows.join(counts, bucket)
        .withColumn("_k", k)
        .withColumn("_s", F.pmod(F.xxhash64(F.lit(7), member), F.col("_k")).cast("int"))
        .withColumn("_t", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("_a", F.least("_s", "_t"))
        .withColumn("_b", F.greatest("_s", "_t"))
        .drop("_m", "_k", "_t")
    )
    if payload is not None:
        dealt = dealt.join(payload, [c for c in payload.columns if c in rows.columns])
    keys = [bucket, "_a", "_b"]
    arrow_schema = None

    def run(batches):
        for (key, a, b), table in sorted_groups(batches, keys):
            if table.num_rows < 2:
                continue
            if a == b:
                out = fn(int(key), table, None)
            else:
                side = table.column("_s").to_numpy()
                left, right = table.filter(pa.array(side == a)), table.filter(pa.array(side == b))
                out = fn(int(key), left, right) if left.num_rows and right.num_rows else None
            if out is not None and len(next(iter(out.values()))):
                yield pa.RecordBatch.from_pydict(out, schema=arrow_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow_schema = to_arrow_schema(StructType.fromDDL(schema))
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def release_memory(*forget: Callable[[], None]) -> None:
    """Give memory back at the end of a task: workers outlive their tasks.

    ``forget`` clears what the worker remembers. The C library keeps freed memory for itself
    until it is asked; where it can't be asked, nothing is lost.
    """
    for f in forget:
        f()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def spare(columns: Sequence[str], *names: str) -> tuple[str, ...]:
    """The names, each lengthened until no column is called like it."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def lists_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.chunk(0) if arr.num_chunks else pa.array([], type=arr.type)
    offsets = arr.offsets.to_numpy()
    values = arr.values.to_numpy(zero_copy_only=False)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest id that each node reaches: ``node``, ``comp``, for nodes with an edge.

    ``edges`` has long columns ``a`` and ``b``. Large-star and small-star steps alternate
    until nothing changes, which takes a number of rounds that is logarithmic in practice.
    Each step is one pre-aggregated minimum and one join by node, which Spark splits where a
    node is hot; edges are written after each round, so a lost executor costs a re-read.
    An empty input gives no rows. Loops (a = b) stand for nodes without partners.
    """
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("comp"))
    edges = durable(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = durable(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % 1_000_000_007).alias("h")
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return nodes.union(roots).union(loops).groupBy("node").agg(F.min("comp").alias("comp"))
