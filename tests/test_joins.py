"""Set joins, vector search and similarity against brute force."""

import dataclasses
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark import queries
from shelfmark.functions.scores import Weights
from shelfmark.operators import groups, setjoin, vectors
from shelfmark.plans import dense, evaluation, search, series
from shelfmark.plans import similar as sim
from shelfmark.queries import QUERIES
from shelfmark import session
from shelfmark.session import durable


def random_sets(seed, n, vocabulary, longest):
    r = random.Random(seed)
    # Square the draw so that a few tokens are in most sets.
    return {i: sorted({f"t{int(vocabulary * r.random() ** 3)}" for _ in range(r.randint(1, longest))}) for i in range(n)}


def brute_pairs(sets, t):
    out = {}
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = set(sets[a]), set(sets[b])
            j = len(x & y) / len(x | y)
            if j >= t:
                out[(a, b)] = j
    return out


@pytest.mark.parametrize("t", [0.3, 0.5, 0.6, 0.8, 1.0])
@pytest.mark.parametrize("hot", [1, 4, 2000])
def test_similar_sets_equal_brute_force(spark, t, hot):
    sets = random_sets(7, 120, 40, 9)
    distinct = {v: k for k, v in reversed([(k, tuple(s)) for k, s in sets.items()])}
    sets = {k: list(v) for v, k in distinct.items()}
    df = spark.createDataFrame([(k, v, len(v)) for k, v in sets.items()], "set_id long, tokens array<string>, n int")
    got = {(r.a, r.b): r.jaccard for r in setjoin.similar_sets(df, t, hot).collect()}
    assert got == pytest.approx(brute_pairs(sets, t))


def test_set_join_has_no_cartesian_product(spark):
    df = spark.createDataFrame([(1, ["a", "b"], 2), (2, ["a", "c"], 2)], "set_id long, tokens array<string>, n int")
    plan = plan_of(setjoin.similar_sets(df, 0.3))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_groups_of_copies_are_joined_once(spark):
    rows = [(i, ["a", "b", "c"]) for i in range(40)] + [(100, ["a", "b", "c", "d"]), (101, ["x"])]
    found, pairs = setjoin.set_similarity_join(spark.createDataFrame(rows, "id long, c array<string>"), "id", "c", 0.6)
    assert {(r.set_id, r.members) for r in found.collect()} == {(0, 40), (100, 1), (101, 1)}
    assert [(r.a, r.b, r.jaccard) for r in pairs.collect()] == [(0, 100, 0.75)]


def test_schema_pairs_are_all_pairs(spark):
    sets = random_sets(3, 60, 12, 4)
    sets |= {i: ["same", "columns", "here"] for i in range(1000, 1060)}
    slugs = {i: [f"c{i % 3}"] if i % 5 else [] for i in sets}
    df = spark.createDataFrame(
        [(i, f"T{i}", c, slugs[i]) for i, c in sets.items()],
        "id long, title string, columns array<string>, category_slugs array<string>",
    )
    want = brute_pairs(sets, 0.6)
    rows = evaluation.schema_pairs(df, title="title").collect()
    got = {(r.dataset_a_id, r.dataset_b_id): (r.jaccard_score, r.same_category) for r in rows}
    assert len(rows) == len(got)
    assert got == {p: (round(j, 3), bool(set(slugs[p[0]]) & set(slugs[p[1]]))) for p, j in want.items()}
    links, members = evaluation.schema_links(df)
    links, of = links.collect(), {}
    for m in members.collect():
        of.setdefault(m.group_id, []).append(m.id)
    assert sorted(i for v in of.values() for i in v) == sorted(sets)
    expanded = set()
    for r in links:
        a, b = of[r.group_a], of[r.group_b]
        pairs = {tuple(sorted((x, y))) for x in a for y in b if x != y}
        assert len(pairs) == r.n_pairs
        expanded |= pairs
    assert expanded == set(want) and sum(r.n_pairs for r in links) == len(want)

def test_pairs_with_one_frequent_word_in_common_are_dropped_by_count(spark):
    # Every two sets share the word "all", which is rare in none; only twins share more.
    rows = [(i, sorted(["all", *(f"w{i // 2}-{j}" for j in range(5)), f"own{i}"])) for i in range(60)]
    df = spark.createDataFrame([(i, c, len(c)) for i, c in rows], "set_id long, tokens array<string>, n int")
    keys = {r.set_id: r.first for r in setjoin._prefix_keys(df, 0.6, 2000).select("set_id", "first").collect()}
    assert set(keys.values()) == {setjoin.SHARED_FIRST}
    found = setjoin.similar_sets(df, 0.6, shared=True).collect()
    assert {(r.a, r.b) for r in found} == {(i, i + 1) for i in range(0, 60, 2)}
    assert all(r.shared == sorted(set(rows[r.a][1]) & set(rows[r.b][1])) for r in found)


@pytest.mark.parametrize("t", [0.3, 0.6, 0.9])
def test_long_sets_equal_brute_force_in_small_blocks(spark, monkeypatch, t):
    monkeypatch.setattr(setjoin, "BLOCK_PAIRS", 5)
    r = random.Random(5)
    base = [[f"t{int(300 * r.random() ** 2)}" for _ in range(40)] for _ in range(12)]
    sets = {}
    for i in range(150):
        own = set(base[i % 12]) | {f"x{i}-{j}" for j in range(r.randint(0, 6))}
        sets[i] = sorted(w for w in own if r.random() < 0.9)
    distinct = {v: k for k, v in reversed([(k, tuple(s)) for k, s in sets.items()])}
    sets = {k: list(v) for v, k in distinct.items()}
    df = spark.createDataFrame([(k, v, len(v)) for k, v in sets.items()], "set_id long, tokens array<string>, n int")
    got = {(x.a, x.b): x.jaccard for x in setjoin.similar_sets(df, t, 4).collect()}
    assert got == pytest.approx(brute_pairs(sets, t))


def test_pairs_of_datasets_are_made_by_the_last_join(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "MEETING_ROWS", 7)
    rows = [(i, f"T{i}", ["a", "b", "c"] + ["d"] * (i % 2), ["k"]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, title string, columns array<string>, category_slugs array<string>")
    pairs = evaluation.schema_pairs(df, title="title", shared={"n": lambda c: F.size(c)})
    # no exchange above the join that makes the pairs
    top = plan_of(pairs).split("Join")[0]
    assert "Exchange" not in top
    got = pairs.collect()
    assert len(got) == len({(r.dataset_a_id, r.dataset_b_id) for r in got}) == 40 * 39 // 2
    assert all(r.dataset_a_title == f"T{r.dataset_a_id}" and r.dataset_b_title == f"T{r.dataset_b_id}" for r in got)
    assert {r.n for r in got} == {3, 4}


def test_pairs_come_out_block_by_block(spark, monkeypatch, tmp_path):
    # Three schemas whose datasets take turns, so rows of one schema lie apart in the input.
    rows = [(i, f"T{i}", [f"{c}{i % 3}" for c in "abc"], ["k"]) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, title string, columns array<string>, category_slugs array<string>")
    told = {"shared": lambda c: F.array_join(c, ",")}
    for block in (4_096, 7):
        monkeypatch.setattr(evaluation, "MEETING_ROWS", block)
        evaluation.schema_pairs(df, title="title", shared=told).write.parquet(f"{tmp_path}/{block}")
        parts = [pq.read_table(f).to_pylist() for f in sorted((tmp_path / f"{block}").glob("*.parquet"))]
        pairs = [(r["dataset_a_id"], r["dataset_b_id"]) for p in parts for r in p]
        assert sorted(pairs) == [(a, b) for a in range(120) for b in range(a + 3, 120, 3)]
        assert len(pairs) == 3 * 40 * 39 // 2
        # a schema follows another once per meeting of two blocks, not once per dataset
        turns = sum(x["shared"] != y["shared"] for p in parts for x, y in zip(p, p[1:]))
        assert turns < (3 if block > 40 else 3 * 10 * 11 // 2)
    # a run of one dataset with all of its block
    ids = [[{r["dataset_a_id"], r["dataset_b_id"]} for r in p] for p in parts]
    assert sum(not x & y for p in ids for x, y in zip(p, p[1:])) < len(pairs) / 3


def test_repeated_and_missing_ids_meet_as_before_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "MEETING_ROWS", 2)
    rows = [(i, ["a", "b"], ["k"]) for i in (1, 1, 2, 3, 4, 5, None)]
    df = spark.createDataFrame(rows, "id long, columns array<string>, category_slugs array<string>")
    got = sorted((r.dataset_a_id, r.dataset_b_id) for r in evaluation.schema_pairs(df).collect())
    ids = [1, 1, 2, 3, 4, 5]
    assert got == sorted((a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if a < b)


def test_labels_by_group_count_as_labels_by_pair(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "MEETING_ROWS", 7)
    sets = random_sets(3, 60, 12, 4)
    sets |= {i: ["same", "columns", "here"] for i in range(1000, 1030)}
    rows = [(i, c, [f"c{i % 3}"] if i % 5 else []) for i, c in sets.items()] + [(1003, sets[1003], [])]
    df = spark.createDataFrame(rows, "id long, columns array<string>, category_slugs array<string>")
    links, members = evaluation.schema_links(df)
    fields = ["dataset_a_id", "dataset_b_id", "jaccard_score", "same_category"]
    pairs = sorted(map(tuple, evaluation.linked_pairs(links, members).collect()))
    assert pairs == sorted(map(tuple, evaluation.schema_pairs(df, shared={}).select(*fields).collect()))
    r = random.Random(4)
    judged = {p[:2] for p in pairs if r.random() < 0.6}
    # pairs that are none, in the wrong order and of unknown datasets: judgments on nothing
    judged |= {(b, a) for a, b in list(judged)[:9]} | {(1, 1), (0, 1029), (1, 9999)}
    labels = [(a, b, r.random() < 0.5, r.choice([True, False, None])) for a, b in sorted(judged)]
    labels = spark.createDataFrame(labels, "dataset_a_id long, dataset_b_id long, similar boolean, joinable boolean")
    counts = [F.sum(c).alias(c) for c in ("pairs", "joinable", "similar")]
    for shipped in (True, False):
        monkeypatch.setattr(evaluation, "BROADCAST_BYTES", evaluation.BROADCAST_BYTES if shipped else 0)
        by_group = evaluation.label_links(links, members, labels, "judge")
        got = {tuple(x) for x in by_group.groupBy("label_source").agg(*counts).collect()}
        by_pair = evaluation.attach_labels(evaluation.schema_pairs(df, shared={}), labels, fields[:2], "judge")
        by_pair = by_pair.groupBy("label_source").agg(F.count(F.lit(1)), F.count_if("joinable"), F.count_if("similar"))
        assert got == {tuple(x) for x in by_pair.collect()} and len(got) == 2


def test_judgments_on_all_pairs_are_counted_where_they_lie(spark, monkeypatch, tmp_path):
    html = "<title>t</title>" + "".join(f'<a href="c{i}">x</a>' for i in range(4))
    rows = [(i, f"http://h/en/{i}", html) for i in range(40)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    plans = []

    def told(df):
        plans.append(plan_of(df))
        return durable(df)

    for module in (evaluation, queries):
        monkeypatch.setattr(module, "durable", told)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = QUERIES["labeled_pairs"](spark, str(tmp_path))
        got = {tuple(x) for x in out.collect()}
        plans.append(plan_of(out))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    of = [a + b for a in range(40) for b in range(a + 1, 40)]
    judged = [n for n in of if n % 3]
    assert got == {("judge", len(judged), sum(n % 2 == 0 for n in judged), len(judged)), (None, len(of) - len(judged), 0, 0)}
    assert not any(f"hashpartitioning(dataset_{s}_id" in p for p in plans for s in "ab")


# ── vectors ─────────────────────────────────────────────────────────────────────


def vector_table(spark, seed=1, n=300, copies=100, dim=8):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim))
    rows = [centers[i % 6] + 0.2 * rng.normal(size=dim) for i in range(n - copies)]
    rows += [rows[0]] * (copies - 1) + [np.zeros(dim)]
    data = [(i, [float(np.float32(x)) for x in v], f"g{i % 4}", f"s{i % 7}") for i, v in enumerate(rows)]
    return data, spark.createDataFrame(data, "id long, vector array<float>, grp string, scope string").repartition(4)


def brute_topk(data, k, threshold=None, within=False, one_per=False, drop_self=True):
    m = np.array([d[1] for d in data])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    s = np.round(u @ u.T, 9) + 0.0
    out = {}
    for i, q in enumerate(data):
        hits = sorted((-s[i, j], c[0], c[2]) for j, c in enumerate(data)
                      if (c[0] != q[0] or not drop_self)
                      and (threshold is None or s[i, j] >= threshold) and (not within or c[3] == q[3]))
        if one_per:
            seen, kept = set(), []
            for h in hits:
                if h[2] not in seen:
                    seen.add(h[2])
                    kept.append(h)
            hits = kept
        for rank, h in enumerate(hits[:k], 1):
            out[(q[0], rank)] = (h[1], round(-h[0], 6))
    return out


def as_dict(df):
    return {(r.query_id, r["rank"]): (r.id, round(r.score, 6)) for r in df.collect()}


@pytest.mark.parametrize("plan", ["scan", "grid"])
@pytest.mark.parametrize("options", [{}, {"threshold": 0.9}, {"within": True}, {"one_per": True}, {"within": True, "one_per": True}])
def test_vector_topk_equals_brute_force(spark, plan, options):
    data, df = vector_table(spark)
    names = {"within": "scope", "one_per": "grp"}
    args = {k: (names[k] if v is True else v) for k, v in options.items()}
    got = as_dict(vectors.vector_topk(df, df, 4, drop_self=True, plan=plan, slice_rows=40, **args))
    assert got == brute_topk(data, 4, **options)


def test_slices_of_a_grid_grow_with_the_table(spark, monkeypatch):
    def slices(n):
        return -(-n // vectors._slice_rows(n, 64, 12))

    # a vector travels once a slice: as often over 700,000 vectors as over 150,000
    assert slices(150_000) == slices(300_000) == slices(700_000) == 7
    assert vectors._slice_rows(20_000, 64, 12) == 16_384 and vectors._slice_rows(10**9, 64, 12) == 131_072
    seen = []
    grid = vectors._grid
    monkeypatch.setattr(vectors, "_grid", lambda *a: seen.append(a[-2:]) or grid(*a))
    monkeypatch.setattr(vectors, "SLICE_ROWS", 16)
    monkeypatch.setattr(vectors, "SLICE_BYTES", 0)
    data, df = vector_table(spark)
    got = as_dict(vectors.vector_topk(df, df, 4, drop_self=True, plan="grid"))
    assert got == brute_topk(data, 4) and seen == [(-(-len(data) // 6),) * 2]


@pytest.mark.parametrize("plan", ["scan", "grid"])
def test_vector_pairs(spark, plan):
    data, df = vector_table(spark, n=120, copies=20)
    got = {(r.query_id, r.id) for r in vectors.vector_pairs(df, df, 0.95, plan=plan, slice_rows=30).collect()}
    m = np.array([d[1] for d in data])
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    u = np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)
    want = {(i, j) for i, j in zip(*np.nonzero(np.round(u @ u.T, 9) >= 0.95))}
    assert got == want


def points(vectors_, **columns):
    ids = pa.array(range(len(vectors_)))
    return vectors._Side(pa.table({"id": ids, "vector": pa.array(list(vectors_)), **columns}))


@pytest.mark.parametrize("n_groups", [3, 700])
def test_search_by_group_ranks_few_rows(monkeypatch, n_groups):
    r = np.random.default_rng(5)
    m = np.concatenate([r.normal(size=(2900, 16)) + 1.0, np.ones((100, 16))])
    names = np.arange(3000) % n_groups
    side = points(m, one_per=pa.array([f"g{i}" for i in names]))
    ranked = []
    cut = vectors._cut
    monkeypatch.setattr(vectors, "_cut", lambda r, *rest: ranked.append(len(r)) or cut(r, *rest))
    rows, cols, _ = vectors._best(points(m[:200]), side, 5, None, True)
    assert sum(ranked) < 0.1 * 200 * 3000 or n_groups < 5
    s = np.round(side.unit[:200] @ side.unit.T, 9)
    s[np.arange(200), np.arange(200)] = -np.inf
    for q in range(0, 200, 20):
        best = {}
        for i in np.lexsort((np.arange(3000), -s[q])):
            best.setdefault(names[i], int(i))
        assert cols[rows == q].tolist() == list(best.values())[:5]


def test_scan_keeps_what_ties_over_batches(spark):
    # the k best lie in the last batch of a task, and ties of the k-th best in all of them
    near = [[1.0, i / 4000.0] for i in range(4000)]
    df = spark.createDataFrame([(3999 - i, v) for i, v in enumerate(near)] + [(4000 + i, near[10]) for i in range(50)],
                               "id long, vector array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        hits = vectors.vector_topk(df.where("id = 3999"), df.coalesce(1), 12).orderBy("rank").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [h.id for h in hits] == [3999 - i for i in range(11)] + [4000]


def test_scan_sends_on_as_much_from_any_number_of_files(spark):
    # each task sends on k rows per query, so tasks must not grow in number with a small corpus
    ids = spark.range(1200).select("id", F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vector"))
    for parts in (1, 64):
        found = vectors._search(ids, ids.repartition(parts), 3, None, True, "scan", None)
        assert found.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_vectors_of_different_length_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0])], "id long, vector array<float>")
    with pytest.raises(Exception, match="differ in length"):
        vectors.vector_topk(df, df, 1).collect()
    good, bad = vectors.check_dimension(df, 2)
    assert (good.count(), bad.count()) == (1, 1)


def test_string_ids_and_threshold_rule(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", [-1.0, 0.0])], "id string, vector array<float>")
    assert vectors.vector_topk(df, df, 9, threshold=0.0, drop_self=True).count() == 6
    assert vectors.vector_topk(df, df, 9, threshold=0.5, drop_self=True).count() == 2


# ── similar datasets ────────────────────────────────────────────────────────────

RECORD = (
    "id long, title string, series_key string, organization_id string, category_slugs array<string>, "
    "frequency string, covered boolean, columns array<string>"
)


def random_records(seed, n=90, hot=True):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = sorted({f"w{int(15 * r.random() ** 2)}" for _ in range(r.randint(0, 3))})
        columns = sorted({f"c{int(30 * r.random() ** 2)}" for _ in range(r.randint(0, 5))})
        if hot and i % 3 == 0:
            columns = sorted({*columns, "year"})
        if i % 9 == 0:
            columns = [f"only{i}"]
        rows.append(
            (
                i,
                f"T{i}",
                " ".join(words),
                None if i % 7 == 0 else f"o{i % 4}",
                [f"k{i % 5}", f"k{(i * i) % 6}"] if i % 8 else [],
                [None, "", "Annual", "Monthly"][i % 4],
                i % 5 < 2,
                columns,
            )
        )
    return rows


def brute_similar(rows, scope, options, column_score):
    out = {}
    w = options.weights
    for x in rows:
        scored = []
        for y in rows:
            if x[0] == y[0]:
                continue
            if scope == "category" and not set(x[4]) & set(y[4]):
                continue
            if scope == "organization" and (x[3] != y[3] or (x[3] is None and not options.match_null_org)):
                continue
            a, b = set(x[2].split()), set(y[2].split())
            title = len(a & b) / len(a | b) if a and b else 0.0
            time = (0.5 if x[5] and x[5] == y[5] else 0) + (0.5 if x[6] and y[6] else 0)
            score = w.columns * column_score(x[7], y[7]) + w.title * title + w.temporal * time
            key = y[2] if y[2] or options.collapse_empty else f"#{y[0]}"
            scored.append((-score, y[0], key))
        seen = set()
        rank = 0
        for s, i, key in sorted(scored):
            if key in seen:
                continue
            seen.add(key)
            rank += 1
            if rank > options.k:
                break
            out[(x[0], rank)] = (i, round(-s, 4))
    return out


def equal_columns(a, b):
    return len(set(a) & set(b)) / max(len(a), len(b)) if a and b else 0.0


@pytest.mark.parametrize("scope", sim.SCOPES)
@pytest.mark.parametrize(
    "options",
    [sim.Options(), sim.Options(k=3, match_null_org=False, collapse_empty=True), sim.Options(k=40)],
)
def test_similar_equals_brute_force(spark, monkeypatch, scope, options):
    monkeypatch.setattr(sim, "SALT_ROWS", 7)
    monkeypatch.setattr(sim, "PROBE_ROWS", 3)
    rows = random_records(5)
    best = sim.similar_datasets(spark.createDataFrame(rows, RECORD), options, (scope,))
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in best.collect()}
    assert got == brute_similar(rows, scope, options, equal_columns)


@pytest.mark.parametrize("seed", [11, 12])
def test_similar_by_column_vectors(spark, seed):
    rows = random_records(seed, 60)
    rng = np.random.default_rng(0)
    names = sorted({c for r in rows for c in r[7]})
    # Every third column is a copy of the first one; some columns have no vector at all.
    base = rng.normal(size=6)
    vecs = {}
    for i, c in enumerate(names):
        if i % 5 == 4:
            continue
        vecs[c] = base if i % 3 == 0 else base + rng.normal(size=6) * 0.4
    table = spark.createDataFrame(
        [(c, [float(np.float32(x)) for x in v]) for c, v in vecs.items()], "title string, vector array<float>"
    )
    unit = {c: np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) for c, v in vecs.items()}

    def column_score(a, b):
        total = 0.0
        for x in a:
            best = max((round(float(unit[x] @ unit[y]), 9) for y in b if x in unit and y in unit), default=0.0)
            total += best if best >= 0.85 else 0.0
        return total / max(len(a), len(b)) if a and b else 0.0

    matches = search.column_similarity(table)
    options = sim.Options(weights=Weights())
    best = sim.similar_datasets(spark.createDataFrame(rows, RECORD), options, ("global",), matches)
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in best.collect()}
    want = brute_similar(rows, "global", options, column_score)
    assert got.keys() == want.keys()
    assert [s for _, s in (got[k] for k in sorted(got))] == pytest.approx([want[k][1] for k in sorted(want)], abs=1e-4)


@pytest.mark.parametrize("scope", ["global", "category"])
def test_similar_in_blocks_of_column_vectors(spark, monkeypatch, scope):
    rows = random_records(3, 60)
    rng = np.random.default_rng(1)
    names = sorted({c for r in rows for c in r[7]})
    vecs = {c: np.float32(rng.normal(size=6) + 0.5) for i, c in enumerate(names) if i % 5 < 4}
    unit = {c: v.astype(float) / np.linalg.norm(v.astype(float)) for c, v in vecs.items()}

    def column_score(a, b):
        total = 0.0
        for x in a:
            best = max((round(float(unit[x] @ unit[y]), 9) for y in b if x in unit and y in unit), default=0.0)
            total += best if best >= 0.3 else 0.0
        return total / max(len(a), len(b)) if a and b else 0.0

    table = spark.createDataFrame([(c, v.tolist()) for c, v in vecs.items()], "title string, vector array<float>")
    monkeypatch.setattr(dense, "BLOCK", 60)
    matches = search.column_vectors(table, 0.3)
    # most columns match: no table of matches is made
    assert [f.name for f in dataclasses.fields(matches)] == ["names", "threshold"] and matches.names.count() == len(vecs)
    best = sim.similar_datasets(spark.createDataFrame(rows, RECORD), sim.Options(), (scope,), matches)
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in best.collect()}
    want = brute_similar(rows, scope, sim.Options(), column_score)
    assert got.keys() == want.keys()
    assert [got[k][1] for k in sorted(got)] == pytest.approx([want[k][1] for k in sorted(want)], abs=1e-4)


def test_strips_cover_all_targets(monkeypatch):
    class Records:
        ids, ends = np.arange(6), np.array([0, 3, 3, 50, 51, 51, 60])

    for held in (1, 40, 10_000):
        monkeypatch.setattr(dense, "STRIP", held)
        runs = list(dense._strips(Records, 2))
        assert [i for r in runs for i in range(r.start, r.stop)] == list(range(6))


def test_hit_rate_searches_once(spark):
    assert "MapInArrow" not in plan_of(QUERIES["hit_rate"](spark, "/root/testdata/sf0.001"))


def test_similar_for_chosen_targets(spark):
    rows = random_records(5)
    df = spark.createDataFrame(rows, RECORD)
    some = spark.createDataFrame([(3,), (9,)], "id long")
    best = sim.similar_datasets(df, scopes=("global",), targets=some)
    got = {(r.target_id, r["rank"]): (r.dataset_id, r.score) for r in best.collect()}
    want = brute_similar(rows, "global", sim.Options(), equal_columns)
    assert got == {k: v for k, v in want.items() if k[0] in (3, 9)}


# ── groups and series ───────────────────────────────────────────────────────────


def test_counts_with_heavy_keys(spark):
    rows = [("hot", i) for i in range(50)] + [(f"k{i % 9}", i) for i in range(30)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    got = {(r.k, r.n) for r in groups.attach_counts(df, ["k"], salt_rows=7).collect()}
    assert ("hot", 50) in got and len(got) == 10
    assert groups.attach_counts(df, ["k"], salt_rows=7).count() == 80


def test_skew_join_equals_join(spark):
    rows = [("hot", i) for i in range(50)] + [(f"k{i % 9}", i) for i in range(30)] + [(None, 1)]
    df = spark.createDataFrame(rows, "k string, v int")
    small = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "k string, w int")
    for how in ("inner", "left"):
        got = sorted(groups.skew_join(df, small, ["k"], how, salt_rows=7).collect(), key=str)
        assert got == sorted(df.join(small, "k", how).collect(), key=str)


def test_lists_are_whole(spark):
    df = spark.createDataFrame([("a", i) for i in range(2500)] + [("b", 1), (None, 2)], "k string, id long")
    lists = {r.k: r for r in groups.id_lists(df, "k", "id").collect()}
    assert lists.keys() == {"a", "b"}
    assert lists["a"].ids == list(range(2500)) and lists["a"].n_ids == 2500
    assert lists["b"].ids == [1]


def test_series_lists_are_full(spark):
    rows = [(i, f"big {i}", "big") for i in range(1201)] + [(2000, "x", "pair"), (2001, "y", "pair"), (2002, "z", ""), (2003, "q", "alone")]
    members = series.series_members(spark.createDataFrame(rows, "id long, title string, series_key string"))
    cases = {r.query_dataset_id: r for r in series.series_pairs(members).collect()}
    assert set(cases) == {*range(1201), 2000, 2001}
    assert cases[2000].relevant_dataset_ids == [2001] and cases[2000].n_relevant == 1
    for i in (0, 700):
        assert cases[i].relevant_dataset_ids == [j for j in range(1201) if j != i]
        assert cases[i].n_relevant == 1200
    found = spark.createDataFrame([(0, 7), (2000, 2000), (2001, 3)], "query_id long, id long")
    assert [r.query_id for r in evaluation.series_hits(found, members).collect()] == [0]


@pytest.mark.parametrize("between", [",", " + "])
def test_series_lists_as_texts_of_many_tasks(spark, monkeypatch, between):
    names = ["9", "10", "é", "100", "1", "11", "11", "0"]
    rows = [(x, "t", "mixed") for x in names] + [(f"{i}", "t", "big") for i in range(300)] + [("a", "t", "two"), ("b", "t", "two")]
    members = series.series_members(spark.createDataFrame(rows, "id string, title string, series_key string"))
    whole = {(r.series_key, r.query_dataset_id): r.relevant_dataset_ids for r in series.series_pairs(members).collect()}
    monkeypatch.setattr(series, "LIST_IDS", 5_000)
    told = series.series_pairs(members, between)
    got = {(r.series_key, r.query_dataset_id): r.relevant_dataset_ids for r in told.collect()}
    assert got == {k: between.join(v) for k, v in whole.items()} and len(got) == 309
    # a small table of members, and a long result: one series is listed by several tasks
    by = told.where("series_key = 'big'").groupBy(F.spark_partition_id()).count().collect()
    assert len(by) > 4


def test_labels_only_where_judged(spark):
    pairs = spark.createDataFrame([(1, 2, True, "rule"), (1, 3, True, "rule")], "a int, b int, joinable boolean, label_source string")
    labels = spark.createDataFrame([(1, 2, False, "r")], "a int, b int, joinable boolean, reasoning string")
    got = {r.b: r for r in evaluation.attach_labels(pairs, labels, ["a", "b"], "judge").collect()}
    assert (got[2].joinable, got[2].reasoning, got[2].label_source) == (False, "r", "judge")
    assert (got[3].joinable, got[3].reasoning, got[3].label_source) == (True, None, "rule")


def test_hit_rate_without_queries_is_null(spark):
    none = spark.createDataFrame([], "query_id long")
    assert tuple(evaluation.hit_rate(none, none).first()) == (0, 0, None)


def test_topk_is_cut_before_the_shuffle(spark):
    from shelfmark.operators.rank import topk_per_key

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(topk_per_key(df, ["k"], [F.col("id").desc()], 2))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_joinable_pairs_stay_where_they_are_made(spark):
    """Only the few results are moved; repeated cases and cases without results count."""
    rows = [(1, 2, True), (1, 2, True), (2, 3, True), (4, None, True), (5, 6, False)]
    labeled = spark.createDataFrame(rows, "dataset_a_id long, dataset_b_id long, joinable boolean")
    similar = spark.createDataFrame([(1, 2), (1, 2), (3, 2), (5, 6)], "target_id long, dataset_id long")
    rate = evaluation.evaluate_joinable(similar, labeled)
    assert [tuple(r) for r in rate.collect()] == [(4, 2, 0.5)]
    assert "hashpartitioning" not in plan_of(rate)


def test_tables_of_a_set_join_go_when_they_are_read(spark, monkeypatch):
    """Of the tables behind a list of pairs only those that it reads are left, and no shuffle files."""
    made = []
    for module in (evaluation, setjoin):
        monkeypatch.setattr(module, "durable", lambda df: made.append(durable(df)) or made[-1])
    rows = [(i, [f"w{j}" for j in range(i % 9, i % 9 + 6)], ["k"]) for i in range(60)]
    sets = spark.createDataFrame(rows, "id long, columns array<string>, category_slugs array<string>")
    pairs = evaluation.schema_pairs(sets, shared={})
    left = [df for df in made if df._table in session._tables]
    assert pairs.count() and len(left) < len(made) / 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_long_lists_of_members_are_not_shipped(spark, monkeypatch):
    """Lists that go to every task twice have a smaller limit than a table that goes once."""
    sets = spark.createDataFrame(
        [(i, [f"c{i % 3}"], ["k"], f"T{i}") for i in range(40)],
        "id long, columns array<string>, category_slugs array<string>, title string",
    )
    held = 40 * (64 + 2) + 40 * 3
    monkeypatch.setattr(evaluation, "BROADCAST_BYTES", held * 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = evaluation.schema_pairs(sets, title="title", shared={})
        assert "BroadcastHashJoin" not in plan_of(pairs)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert pairs.count() == 14 * 13 // 2 + 2 * (13 * 12 // 2)
