"""Similar datasets: the embedding term, columns that match many others, hot candidates."""

import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark.functions.scores import PLANNED_WEIGHTS, Weights
from shelfmark.operators import vectors
from shelfmark.plans import meet, search
from shelfmark.plans import similar as sim
from test_joins import RECORD, brute_similar, equal_columns, random_records


def record_vectors(rows, seed, dim=8):
    """Some clustered, some equal, some null or zero."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    out = {}
    for r in rows:
        i = r[0]
        if i % 11 == 3:
            out[i] = None
        elif i % 13 == 5:
            out[i] = [0.0] * dim
        elif i % 6 == 0:
            out[i] = [float(x) for x in centres[i % 5]]
        else:
            out[i] = [float(x) for x in centres[i % 5] + rng.normal(size=dim) * 0.6]
    return out


def brute_planned(rows, vecs, scope, options):
    """Every pair of the scope, scored in plain Python."""
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vecs.items() if v is not None and np.linalg.norm(v) > 0}
    w, out = options.weights, {}
    for x in rows:
        scored = []
        for y in rows:
            if x[0] == y[0]:
                continue
            if scope == "category" and not set(x[4]) & set(y[4]):
                continue
            if scope == "organization" and x[3] != y[3]:
                continue
            a, b = set(x[2].split()), set(y[2].split())
            title = len(a & b) / len(a | b) if a and b else 0.0
            time = (0.5 if x[5] and x[5] == y[5] else 0) + (0.5 if x[6] and y[6] else 0)
            near = max(0.0, round(float(unit[x[0]] @ unit[y[0]]), 9)) if x[0] in unit and y[0] in unit else 0.0
            score = w.columns * equal_columns(x[7], y[7]) + w.title * title + w.temporal * time + w.embedding * near
            scored.append((-score, y[0], y[2] or f"#{y[0]}"))
        seen, rank = set(), 0
        for s, i, key in sorted(scored):
            if key not in seen and rank < options.k:
                seen.add(key)
                rank += 1
                out[(x[0], rank)] = (i, round(-s, 4))
    return out


@pytest.mark.parametrize(
    "scope, weights",
    [
        ("global", PLANNED_WEIGHTS), ("category", PLANNED_WEIGHTS), ("organization", PLANNED_WEIGHTS),
        ("global", Weights(0.0, 0.0, 0.2, 0.8)), ("category", Weights(0.5, 0.3, 0.15, 0.05)),
    ],
)
def test_embedding_term_equals_brute_force(spark, monkeypatch, scope, weights):
    monkeypatch.setattr(sim, "SALT_ROWS", 7)
    monkeypatch.setattr(sim, "PROBE_ROWS", 3)
    monkeypatch.setattr(sim, "PAIR_ROWS", 20)
    rows = random_records(21, 60)
    vecs = record_vectors(rows, 4)
    options = sim.Options(weights=weights, k=4)
    df = spark.createDataFrame([(*r, vecs[r[0]]) for r in rows], RECORD + ", vector array<double>")
    best = sim.similar_datasets(df, options, (scope,))
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in best.collect()}
    want = brute_planned(rows, vecs, scope, options)
    assert got.keys() == want.keys()
    for key, (i, score) in want.items():
        assert got[key][1] == pytest.approx(score, abs=1.01e-4)
        # a different id only where scores are equal to the last digit
        assert got[key][0] == i or got[key][1] == pytest.approx(score, abs=1e-9)


def test_embedding_term_needs_vectors(spark):
    df = spark.createDataFrame(random_records(1, 5), RECORD)
    with pytest.raises(ValueError, match="vector"):
        sim.similar_datasets(df, sim.Options(weights=PLANNED_WEIGHTS), ("global",))
    none = df.withColumn("vector", F.lit(None).cast("array<double>"))
    best = sim.similar_datasets(none, sim.Options(weights=PLANNED_WEIGHTS), ("global",)).collect()
    assert best and all(r.embedding_similarity == 0 for r in best)


@pytest.mark.parametrize("plan", ["scan", "grid"])
def test_vector_reach_by_own_floor(spark, plan):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(120, 5))
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    floor = rng.uniform(0.2, 0.95, 120)
    rows = [(i, [float(x) for x in v], float(floor[i]), f"g{i % 3}") for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "id long, vector array<double>, floor double, g string")
    near = np.round(unit @ unit.T, 9) >= floor[:, None]
    got = {tuple(r) for r in vectors.vector_reach(df, df, "floor", plan=plan, slice_rows=16).collect()}
    assert got == set(zip(*np.nonzero(near)))
    got = {tuple(r) for r in vectors.vector_reach(df, df, "floor", "g", plan, 16).collect()}
    assert got == {(i, j) for i, j in zip(*np.nonzero(near)) if i % 3 == j % 3}


def test_floor_spares_most_vectors(spark, monkeypatch):
    """A clustered collection is not scored all against all."""
    rows = [
        (i, f"T{i}", f"s{i}", None, [], None, False, [f"c{i}"]) for i in range(300)
    ]
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    vecs = [[float(x) for x in centres[i % 40] + rng.normal(size=16) * 0.05] for i in range(300)]
    df = spark.createDataFrame([(*r, v) for r, v in zip(rows, vecs)], RECORD + ", vector array<double>")
    sizes = []
    plain = sim.score_pairs

    def counted(pairs, *rest):
        sizes.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(sim, "score_pairs", counted)
    sim.similar_datasets(df, sim.Options(weights=PLANNED_WEIGHTS), ("global",)).collect()
    assert sum(sizes) < 300 * 60


def test_many_near_equal_columns(spark):
    """Thousands of columns that all match one another stay rows; no list of matches is built."""
    n = 600
    rng = np.random.default_rng(2)
    base = rng.normal(size=4)
    names = [f"col{i}" for i in range(n)]
    table = spark.createDataFrame(
        [(c, [float(x) for x in base + rng.normal(size=4) * 1e-3]) for c in names], "title string, vector array<double>"
    )
    rows = [(i, f"T{i}", f"s{i}", None, [], None, False, names[i * 5 : i * 5 + 5]) for i in range(n // 5)]
    targets = spark.createDataFrame([(0,), (7,)], "id long")
    matches = search.column_similarity(table)
    assert matches.looks.columns == ["rep", "b", "sim"] and matches.looks.count() == n * n
    best = sim.similar_datasets(
        spark.createDataFrame(rows, RECORD), sim.Options(), ("global",), matches, targets
    )
    got = best.collect()
    assert len(got) == 10 and all(r.column_overlap > 0.999 for r in got)
    assert "collect_list(struct(b" not in plan_of(best)


def test_hot_candidates_are_dealt(spark, monkeypatch):
    """All targets meet the same few candidates; their pairs go to several parts."""
    monkeypatch.setattr(sim, "PAIR_ROWS", 16)
    rows = [(i, f"T{i}", f"s{i}", None, [], "Annual", True, [f"only{i}"]) for i in range(150)]
    df = spark.createDataFrame(rows, RECORD)
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in sim.similar_datasets(df, scopes=("global",)).collect()}
    assert got == brute_similar(rows, "global", sim.Options(), equal_columns)


def test_only_pairs_that_can_still_win_are_scored_on(spark):
    recs = spark.createDataFrame(
        [(i, f"T{i}", f"s{i}", "o", ["k"], None, False, ["a", "b"]) for i in range(6)],
        "id long, title string, series_key string, organization_id string, category_slugs array<string>, "
        "frequency string, covered boolean, columns array<string>",
    )
    framed = sim.frame(recs)
    pairs = spark.createDataFrame([(0, i) for i in range(1, 6)], "target_id long, id long")
    (score,) = {r.score for r in sim.score_pairs(pairs, framed, sim.DEFAULT_WEIGHTS).collect()}
    floors = spark.createDataFrame([(0, score, 3)], "target_id long, floor double, last long")
    left = sim.score_pairs(pairs, framed, sim.DEFAULT_WEIGHTS, floors=floors)
    assert sorted(r.id for r in left.collect()) == [1, 2] and "floor" not in left.columns
    lower = spark.createDataFrame([(0, score / 2, 3)], "target_id long, floor double, last long")
    assert sim.score_pairs(pairs, framed, sim.DEFAULT_WEIGHTS, floors=lower).count() == 5


@pytest.mark.parametrize("limit", [0, 1 << 27])
def test_same_scores_whether_records_are_sent_or_dealt(spark, monkeypatch, limit):
    monkeypatch.setattr(sim, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(sim, "PAIR_ROWS", 4)
    rows = [(i, f"T{i}", f"s{i}", None, [], "Annual", True, [f"c{i // 4}"]) for i in range(40)]
    framed = sim.frame(spark.createDataFrame(rows, RECORD))
    pairs = spark.createDataFrame([(i, j) for i in range(40) for j in (0, 1) if i != j], "target_id long, id long")
    got = {(r.target_id, r.id): r.column_overlap for r in sim.score_pairs(pairs, framed, sim.DEFAULT_WEIGHTS).collect()}
    assert got == {(i, j): float(i // 4 == 0) for i in range(40) for j in (0, 1) if i != j}


@pytest.mark.parametrize("scope", sim.SCOPES)
@pytest.mark.parametrize("dearer", [0, 1_000])
def test_blocks_of_a_scope_equal_brute_force(spark, monkeypatch, scope, dearer):
    """Slices, blocks and classes of equal records change where pairs are compared, not what is found."""
    for name, value in (("BLOCK", 25), ("SLICE", 16), ("SEEDS", 2), ("DEARER", dearer)):
        monkeypatch.setattr(meet, name, value)
    rows = random_records(8, 40)
    rows += [(i + 40, *r[1:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, RECORD)
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in sim.similar_datasets(df, scopes=(scope,)).collect()}
    assert got == brute_similar(rows, scope, sim.Options(), equal_columns)


def test_no_table_of_pairs_is_written(spark, monkeypatch):
    """Records that all share a word and a column: what is kept is a few rows per target, not all pairs."""
    n, written = 120, []
    rows = [(i, f"T{i}", f"budget s{i}", "o", [], None, False, ["year", f"c{i % 7}"]) for i in range(n)]
    plain = sim.durable

    def counted(df):
        out = plain(df)
        written.append(out.count())
        return out

    for module in [m for name, m in sys.modules.items() if name.startswith("shelfmark.")]:
        if getattr(module, "durable", None) is plain:
            monkeypatch.setattr(module, "durable", counted)
    assert sim.similar_datasets(spark.createDataFrame(rows, RECORD), scopes=("organization",)).count() == 5 * n
    assert max(written) <= 5 * n


def test_records_with_several_rows_or_no_lists(spark):
    """An id with different rows is never its own neighbour; an overlap that is not known comes last."""
    rows = [
        (1, "A", "a b", "o", [], "Annual", True, ["x", "y"]), (1, "A", "c", "o", [], None, False, ["x", "y"]),
        (2, "B", "b", "o", [], "Annual", True, ["x"]), (3, "C", "d", "o", [], None, False, None),
    ]
    best = sim.similar_datasets(spark.createDataFrame(rows, RECORD), scopes=("organization",)).where("target_id != 1")
    got = sorted({(r.target_id, r["rank"], r.dataset_id, r.score) for r in best.collect()})
    assert [g[:3] for g in got] == [(2, 1, 1), (2, 2, 1), (2, 3, 3), (3, 1, 1), (3, 2, 1), (3, 3, 2)]
    assert got[2][3] is None
