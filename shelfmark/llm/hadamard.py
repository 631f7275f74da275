"""Centroid clustering: Lloyd rounds on whole numbers, assigned by a Walsh-Hadamard search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.blocks import lists_of
from shelfmark.session import durable

DIM, SCALE = 64, 1024
CENTROIDS, ROUNDS, SEED = 8, 10, 3
# Whole components up to here keep 64 squared coefficient differences within 63 bits.
LARGEST = 2**24
# Coefficients that have been added up when centroids are compared, coarse to fine.
LEVELS = (1, 2, 4, 8, 16, 32, 64)
ROWS_PER_STEP = 4_096


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Rows of 64 whole numbers to their Walsh coefficients, fewest sign changes first.

    The transform is its own inverse but for a factor of 64, and keeps squared distances but
    for the same factor; in whole numbers nothing is rounded.
    """
    out = x.astype(np.int64)
    half = 1
    while half < DIM:
        pairs = out.reshape(len(out), DIM // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack((a + b, a - b), axis=2).reshape(len(out), DIM)
        half *= 2
    return out[:, _ORDER]


def _sequency_order() -> np.ndarray:
    """Natural Hadamard rows by their number of sign changes."""
    index = np.arange(DIM)
    bits = (index[:, None] & index[None, :]).astype(np.uint8)
    odd = np.unpackbits(bits[:, :, None], axis=2).sum(axis=2) & 1
    return np.argsort((odd[:, 1:] != odd[:, :-1]).sum(axis=1), kind="stable")


_ORDER = _sequency_order()
_BACK = np.argsort(_ORDER)


def inverse(coefficients: np.ndarray) -> np.ndarray:
    """Whole numbers from their (summed) coefficients; Python integers may be of any size."""
    out = coefficients[_BACK]
    half = 1
    while half < DIM:
        pairs = out.reshape(-1, 2, half)
        a, b = pairs[:, 0], pairs[:, 1]
        out = np.stack((a + b, a - b), axis=1).reshape(DIM)
        half *= 2
    return out // DIM


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid by number (smallest of equals), squared distance, coefficients compared.

    Both sides are Walsh coefficients. Squared differences are added up level by level. What
    has been added up can only grow, so a centroid that already lies strictly above the full
    distance of some other is out. The first full distance is that of the centroid which is
    nearest after eight coefficients; those that stay to the end are finished to all 64.
    """
    n, k = len(vectors), len(centroids)
    coarse = ((vectors[:, None, :8] - centroids[None, :, :8]) ** 2).sum(axis=2)
    guess = coarse.argmin(axis=1)
    bound = ((vectors - centroids[guess]) ** 2).sum(axis=1)
    row, col = np.divmod(np.arange(n * k), k)
    total = np.zeros(n * k, dtype=np.int64)
    done, work = 0, n * (8 * k + DIM)
    for level in LEVELS:
        diff = vectors[row, done:level] - centroids[col, done:level]
        total += (diff * diff).sum(axis=1)
        work += diff.size
        stay = total <= bound[row]
        row, col, total, done = row[stay], col[stay], total[stay], level
    best = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(best, row, total)
    number = np.full(n, k)
    least = total == best[row]
    np.minimum.at(number, row[least], col[least])
    return number, best // DIM, work


def _coefficients(vectors: DataFrame) -> DataFrame:
    """id, whole numbers, their coefficients; rows that take part only."""

    def run(batches):
        schema = pa.schema([("id", pa.int64()), ("whole", pa.list_(pa.int32())), ("w", pa.list_(pa.int32()))])
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_STEP):
                batch = whole.slice(start, ROWS_PER_STEP)
                x = lists_of(batch.column(1))[0].astype(np.float64).reshape(-1, DIM)
                with np.errstate(over="ignore"):
                    scaled = np.floor(SCALE * x)
                fits = np.abs(scaled).max(axis=1, initial=0) <= LARGEST
                ints = scaled[fits].astype(np.int64)
                offsets = np.arange(len(ints) + 1, dtype=np.int32) * DIM
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(v.ravel().astype(np.int32)))
                    for v in (ints, walsh_hadamard(ints))
                ]
                ids = batch.column(0).filter(pa.array(fits))
                yield pa.RecordBatch.from_arrays([ids, *lists], schema=schema)

    return vectors.mapInArrow(run, "id bigint, whole array<int>, w array<int>")


def _matrix(column) -> np.ndarray:
    return lists_of(column)[0].reshape(-1, DIM).astype(np.int64)


def _sums(table: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and coefficient sums of every cluster: k rows come back, whatever the input."""
    k = len(centroids)

    def run(batches):
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, DIM), dtype=np.int64)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_STEP):
                w = _matrix(whole.column(0).slice(start, ROWS_PER_STEP))
                number, _, _ = nearest(w, centroids)
                count += np.bincount(number, minlength=k)
                for c in range(k):
                    total[c] += w[number == c].sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"c": used.astype(np.int32), "n": count[used], "s": list(total[used])},
            schema=pa.schema([("c", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))]),
        )

    parts = table.select("w").mapInArrow(run, "c int, n bigint, s array<bigint>")
    # decimals: the sum over all tasks may go beyond a long
    sums = [F.sum(F.col("s")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(DIM)]
    count, total = np.zeros(k, dtype=object), np.zeros((k, DIM), dtype=object)
    for r in parts.groupBy("c").agg(F.sum("n").alias("n"), *sums).collect():
        count[r.c] = r.n
        total[r.c] = [int(r[f"s{i}"]) for i in range(DIM)]
    return count, total


def _moved(centroids: np.ndarray, count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of every cluster with vectors; the others stay."""
    out = centroids.copy()
    for c in np.flatnonzero(count):
        out[c] = inverse(total[c]) // count[c]
    return out


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """Clusters of the vectors of 64 finite components, as whole numbers floor(1024 * x).

    One row per vector that takes part: id, ``cluster``, ``distance`` (squared), its cluster's
    and the whole ``inertia``, ``centroid_sha256`` of the final centroid's components. The
    first centroids are the vectors with the smallest sha256 of ``<seed>:<id>`` (of equal ids
    the smaller vector); with fewer vectors there are fewer. Null and otherwise unusable
    vectors are left out, and so is a vector with a component beyond 16384 in size, whose
    squared distances would leave 63 bits; an inertia beyond 63 bits is null. Rows with a null
    id are assigned and counted, but can't be a first centroid; without any id there are no
    rows. Repeated rows are rows of their own; other columns are ignored;
    an empty table gives no rows.

    Vectors are transformed once and written; a round reads them, and sends on one row per
    cluster and task. The driver holds the centroids, and nothing that grows with the input.
    """
    v = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v"))
    table = durable(_coefficients(src.where((F.size(v) == DIM) & F.coalesce(sound, F.lit(False)))))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = table.where("id is not null").orderBy(mark, "whole").limit(centroids).collect()
    now = np.array([r.whole for r in first], dtype=np.int64).reshape(-1, DIM)
    final = "id bigint, cluster int, distance bigint"
    if not len(now):
        empty = table.sparkSession.createDataFrame([], final)
        return _named(empty, now, id_col)
    for _ in range(rounds):
        after = _moved(now, *_sums(table, walsh_hadamard(now)))
        if (after == now).all():
            break  # further rounds change nothing
        now = after
    coarse_to_fine = walsh_hadamard(now)

    def assign(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_PER_STEP):
                batch = whole.slice(start, ROWS_PER_STEP)
                number, distance, _ = nearest(_matrix(batch.column(1)), coarse_to_fine)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                    names=["id", "cluster", "distance"],
                )

    return _named(durable(table.select("id", "w").mapInArrow(assign, final)), now, id_col)


def _named(assigned: DataFrame, centroids: np.ndarray, id_col: str) -> DataFrame:
    """Assigned vectors with what is known of their clusters; as many rows as centroids are joined."""
    digests = [
        (c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids.tolist())
    ]
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia"))
    rows = [(r.cluster, r.cluster_inertia) for r in sums.collect()]
    whole = sum(n or 0 for _, n in rows)
    if whole >= 2**63 or any(n is None for _, n in rows):
        whole = None
    names = dict(digests)
    known = spark.createDataFrame(
        [(c, n, whole, names[c]) for c, n in rows],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(known), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
