import hashlib
import math
import random

import numpy as np
import pytest

from shelfmark.llm import hadamard
from shelfmark.llm.hadamard import DIM, cluster_vectors, inverse, nearest, walsh_hadamard

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(v):
    return [math.floor(1024 * c) for c in v]


def usable(v):
    return v is not None and len(v) == DIM and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, k=8, rounds=10, seed=3):
    """Plain Lloyd rounds on Python integers."""
    kept = [(i, whole(v)) for i, v in rows if usable(v)]
    ids = [(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(ids)[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        now = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (n, _) in zip(kept, now, strict=True) if n == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    now = assign()
    inertia = [sum(d for n, d in now if n == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (i, n, d, inertia[n], sum(inertia), digest[n]) for (i, _), (n, d) in zip(kept, now, strict=True)
    )


def vectors(n, seed=1, groups=5):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(DIM)] for _ in range(groups)]
    return [(i, [m + rng.gauss(0, 0.4) for m in rng.choice(middles)]) for i in range(n)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_transform_keeps_distances_and_turns_back():
    rng = np.random.default_rng(0)
    x = rng.integers(-5000, 5000, size=(40, DIM))
    w = walsh_hadamard(x)
    assert (w[:, 0] == x.sum(axis=1)).all()
    far = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert (((w[:, None] - w[None]) ** 2).sum(axis=2) == DIM * far).all()
    assert (np.array([inverse(r) for r in w]) == x).all()
    big = np.array([10**30 * int(v) for v in x[0]], dtype=object)
    spectrum = np.array([10**30 * int(v) for v in w[0]], dtype=object)
    assert (inverse(spectrum) == big).all()


def test_coefficients_go_from_coarse_to_fine():
    signs = walsh_hadamard(np.eye(DIM, dtype=np.int64)).T
    changes = (signs[:, 1:] != signs[:, :-1]).sum(axis=1)
    assert changes.tolist() == list(range(DIM))


@pytest.mark.parametrize("k", [1, 2, 8, 30])
def test_search_equals_all_distances_and_prunes(k):
    rng = np.random.default_rng(k)
    c = rng.integers(-2000, 2000, size=(k, DIM))
    x = c[rng.integers(0, k, 500)] + rng.integers(-300, 300, size=(500, DIM))
    number, distance, work = nearest(walsh_hadamard(x), walsh_hadamard(c))
    far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    assert (number == far.argmin(axis=1)).all() and (distance == far.min(axis=1)).all()
    if k >= 8:
        assert work < 0.6 * 500 * k * DIM


def test_ties_go_to_the_smaller_number():
    c = np.zeros((4, DIM), dtype=np.int64)
    c[0, 5], c[1, 5], c[2, 5], c[3, 5] = 9, 4, -4, 4
    x = np.zeros((3, DIM), dtype=np.int64)
    number, distance, _ = nearest(walsh_hadamard(x), walsh_hadamard(c))
    assert number.tolist() == [1, 1, 1] and distance.tolist() == [16, 16, 16]


def test_spark_equals_brute_force(spark):
    rows = vectors(150)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    assert rows_of(cluster_vectors(df)) == brute(rows)
    assert rows_of(cluster_vectors(df, centroids=3, rounds=2, seed=9)) == brute(rows, 3, 2, 9)


def test_odd_rows(spark):
    rows = vectors(40, seed=4)
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1]), (100, [0.0] * DIM)]
    left_out = [
        (200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 65), (204, [None] + [1.0] * 63),
        (205, [float("nan")] * DIM), (206, [1.0] * 63 + [float("inf")]), (207, [1.0] * 63 + [-float("inf")]),
    ]
    df = spark.createDataFrame([(i, v, None) for i, v in rows + left_out], SCHEMA)
    got = cluster_vectors(df).collect()
    want = brute(rows[:-2] + rows[-1:] + [(-1, rows[-2][1])])
    # the row without an id can't be a first centroid; give it one that never is
    hashes = sorted(hashlib.sha256(f"3:{i}".encode()).hexdigest() for i, _ in rows if i is not None)
    if hashlib.sha256(b"3:-1").hexdigest() > hashes[7]:
        assert sorted(tuple(r) if r[0] is not None else (-1, *tuple(r)[1:]) for r in got) == want
    assert len(got) == len(rows)
    beyond = spark.createDataFrame([(1, [20000.0] * DIM, 1), (2, [1.0] * DIM, 1)], SCHEMA)
    assert [r.vec_id for r in cluster_vectors(beyond).collect()] == [2]
    huge = spark.createDataFrame([(1, [1e308] * DIM, 1), (2, [1.0] * DIM, 1)], SCHEMA)
    assert [r.vec_id for r in cluster_vectors(huge).collect()] == [2]


def test_few_and_no_vectors(spark):
    rows = vectors(3, seed=2)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert rows_of(cluster_vectors(df)) == brute(rows)
    empty = cluster_vectors(df.limit(0))
    assert empty.collect() == []
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert cluster_vectors(spark.createDataFrame([(None, rows[0][1], 0)], SCHEMA)).collect() == []


def test_all_copies_and_clashing_names(spark):
    v = vectors(1)[0][1]
    df = spark.createDataFrame(
        [(i, v, i, i) for i in range(50)], "vec_id long, embedding array<double>, cluster int, distance int"
    )
    got = cluster_vectors(df).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)} and len(got) == 50


def test_sums_do_not_depend_on_partitions(spark):
    rows = vectors(200, seed=7)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    first = rows_of(cluster_vectors(df.repartition(1)))
    assert rows_of(cluster_vectors(df.repartition(16, "vec_id"))) == first
    assert hadamard.CENTROIDS == 8 and hadamard.ROUNDS == 10
