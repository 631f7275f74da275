import numpy as np

from shelfmark.llm import blocks, e8


def test_nearest_point_is_nearest():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8)) * 2
    got = e8.nearest_e8(x)
    twice = np.rint(got * 2)
    assert ((twice % 2 == 0).all(axis=1) | (twice % 2 == 1).all(axis=1)).all()
    assert (got.sum(axis=1) % 2 == 0).all()
    steps = e8.shortest_steps()
    assert steps.shape == (240, 8) and np.allclose((steps**2).sum(axis=1), 2)
    own = ((x - got) ** 2).sum(axis=1)
    assert (own <= 1 + 1e-9).all()  # covering radius
    near = ((x[:, None] - got[:, None] - steps) ** 2).sum(axis=2).min(axis=1)
    assert (own <= near + 1e-9).all()


def brute(rows, floor):
    parent = {i: i for i, _, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def unit(v):
        if v is None or not v or any(c is None for c in v):
            return None
        a = np.array(v, dtype=np.float64)
        if not np.isfinite(a).all() or not a.any():
            return None
        a = a / np.abs(a).max()
        return a / np.sqrt((a * a).sum())

    units = [unit(v) for _, v, _ in rows]
    links = [0] * len(rows)
    for a, (i, _, p) in enumerate(rows):
        for b, (j, _, q) in enumerate(rows):
            x, y = units[a], units[b]
            if a == b or None in (i, j, p, q) or p != q or x is None or y is None:
                continue
            if len(x) == len(y) and x @ y >= floor:
                links[a] += 1
                lo, hi = sorted((find(i), find(j)))
                parent[hi] = lo
    return links, {i: find(i) for i in parent}


def vectors(rng, n_base, copies, noise, dim=64):
    out = []
    for _ in range(n_base):
        base = rng.normal(size=dim)
        label = int(rng.integers(0, 3))
        for _ in range(int(rng.integers(1, copies))):
            v = base + rng.normal(size=dim) * noise * rng.random()
            out.append((v.astype(np.float32).tolist(), label))
    order = rng.permutation(len(out))
    return [(int(i), *out[k]) for i, k in enumerate(order)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = e8.near_duplicates(df.repartition(4), **options).collect()
    links, comp = brute(rows, 0.98)
    assert len(got) == len(rows)
    assert sorted((r.vec_id, r.n_links) for r in got if r.vec_id is not None) == sorted(
        (i, n) for (i, _, _), n in zip(rows, links, strict=True) if i is not None
    )
    assert {r.vec_id: r.component_id for r in got if r.vec_id is not None} == comp
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_equals_brute_force(spark):
    check(spark, vectors(np.random.default_rng(2), 60, 12, 0.35))


def test_hot_cell_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(blocks.map_buckets, "__defaults__", (9,))
    check(spark, vectors(np.random.default_rng(3), 3, 90, 0.3))


def test_recall_at_the_threshold():
    """Pairs of cosine 0.98 exactly, the hardest that must be found."""
    rng = np.random.default_rng(4)
    a = rng.normal(size=(20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * z
    h = e8.LatticeHash(64)
    salts = np.zeros(len(a), dtype=np.int64)
    x, y = h.cells(a, salts), h.cells(b, salts)
    met = (x[:, :, None] == y[:, None, :]).any(axis=(1, 2))
    assert met.mean() > 0.999
    stray = (x[:, :, None] == np.roll(y, 1, axis=0)[:, None, :]).any(axis=(1, 2))
    assert stray.mean() < 0.01


def test_odd_rows(spark):
    one = [1.0] + [0.0] * 7
    rows = [
        (5, one, 1), (2, one, 1), (9, [2.0] + [0.0] * 7, 1), (3, one, 2), (4, one, None),
        (6, None, 1), (7, [0.0] * 8, 1), (8, [float("nan")] + one[1:], 1), (10, [], 1),
        (11, [float("inf")] + one[1:], 1), (12, [None] + one[1:], 1), (None, one, 1),
        (2, one, 1), (13, one[:4], 1), (14, [1.0, 0.0], 7), (14, [0.0, 1.0], 7), (15, [0.0, 3.0], 7),
        (16, [1e-30] * 8, 3), (17, [1e30] * 8, 3), (18, [-0.0, 1.0], 4), (19, [0.0, 1.0], 4),
    ]
    check(spark, rows)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert e8.near_duplicates(df).count() == 0
    clash = spark.createDataFrame(
        [(1, one, 1, "k", 2.0)], "vec_id long, embedding array<double>, label int, key string, n_links double"
    )
    assert e8.near_duplicates(clash).collect()[0][:] == (1, 0, 1, True)
