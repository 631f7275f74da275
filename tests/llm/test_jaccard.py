import random
import re

import pytest

from shelfmark.llm import jaccard
from shelfmark.llm.blocks import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width):
    w = WORD.findall(lower(text))
    if not w:
        return set()
    if len(w) < width:
        return {tuple(w)}
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, percent):
    """rows: (id, text) -> {id: (set sizes, component)}; rows that share an id are one node."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    for a, x in sets:
        for b, y in sets:
            both = len(x & y)
            if x and y and 100 * both >= percent * (len(x) + len(y) - both):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: find(i) for i in parent}


def family(rng, n_base, copies, edits):
    vocab = ["w%d" % i for i in range(400)]
    rows, i = [], 0
    passage = [rng.choice(vocab) for _ in range(30)]
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 160))]
        if rng.random() < 0.5:
            base += passage
        for _ in range(rng.randint(1, copies)):
            words = list(base)
            for _ in range(rng.randint(0, edits)):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((i, " ".join(words)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent,stretch,seed", [(3, 90, 1.0, 1), (5, 80, 0.5, 2), (2, 70, 0.0, 3)])
def test_equals_brute_force(spark, width, percent, stretch, seed):
    rows = family(random.Random(seed), 40, 8, 5)
    got = jaccard.jaccard_components(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
        width=width,
        percent=percent,
        stretch=stretch,
    ).collect()
    want = brute(rows, width, percent)
    assert {r.doc_id: r.component_id for r in got} == want
    sizes = {i: len(shingles(t, width)) for i, t in rows}
    assert {r.doc_id: r.n_shingles for r in got} == sizes


def test_one_big_family_over_several_blocks(spark, monkeypatch):
    """All share most tokens; blocks of 7 members must lose no link."""
    monkeypatch.setattr(jaccard.map_buckets, "__defaults__", (7,))
    rng = random.Random(5)
    vocab = ["v%d" % i for i in range(60)]
    base = [rng.choice(vocab) for _ in range(80)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(80)] = rng.choice(vocab)
        rows.append((i, " ".join(words)))
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows, 3, 90)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [
        (3, "A b c d", "x"), (1, "a B c D", "y"), (2, None, None), (4, "", "z"), (5, " \t\n", "z"),
        (6, "a", "q"), (7, "A", "q"), (8, "a b", "q"), (None, "a b c d", "n"), (None, None, "n"),
        (3, "A b c d", "x"), (9, " a b", "q"), (10, "e f g h i", ""), (10, "a", ""),
    ]
    df = spark.createDataFrame(
        [(a, b, c, c, 1) for a, b, c in rows],
        "doc_id long, text string, component_id string, key string, id int",
    )
    got = jaccard.jaccard_components(df).collect()
    assert len(got) == len(rows)
    comp = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert comp == {3: 1, 1: 1, 2: 2, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, 10: 6}
    assert [r.component_id for r in got if r.doc_id is None] == [None, None]
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(["1", "2", "4", "5", "6", "8", "9", "None", "None"])
    again = jaccard.keep_one(spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string"))
    assert again.count() == 1


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_components(df).count() == 0
    assert jaccard.keep_one(df).count() == 0


def test_very_long_texts(spark):
    rng = random.Random(3)
    words = ["x%d" % rng.randrange(30000) for _ in range(60000)]
    other = words[:-100] + ["new"] * 100
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, "short one here")]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 1, 3: 3}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300, 300)]
    edges += [(i, i + 1) for i in range(1000, 1100)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        parent[hi] = lo
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.comp for r in got} == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
