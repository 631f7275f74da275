import random

import numpy as np

from conftest import plan_of
from shelfmark.llm import cotrain


def corpus(rng, n):
    docs, labels, truth = [], [], {}
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 120))]
        if not good:
            kind = rng.randrange(3)
            if kind == 0:
                words = [words[0]] * len(words)
            elif kind == 1:
                words = [w.upper() + "!!" for w in words]
            else:
                words = [w + " |" for w in words]
        text = " ".join(words)
        docs.append((i, text, "en", f"src{rng.randrange(5)}" if good else f"bad{rng.randrange(2)}", len(text)))
        truth[i] = good
        if i % 3 == 0:
            labels.append((i, int(good)))
    return docs, labels, truth


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus(random.Random(1), 600)
    df = spark.createDataFrame(docs, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {r.doc_id: r for r in cotrain.score_quality(df, marks).collect()}
    assert got.keys() == truth.keys()
    unseen = [i for i in truth if i % 3]
    right = [got[i].kept == truth[i] for i in unseen]
    assert np.mean(right) > 0.97
    for view in ("p_text", "p_meta"):
        assert np.mean([(got[i][view] >= 0.5) == truth[i] for i in unseen]) > 0.9
    kept = cotrain.keep_good(df, marks)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}


def test_shared_labels(spark):
    """Held-out labels of the shared tables: every fifth label is kept from training."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    seen, unseen = labels.where("doc_id % 5 <> 0"), labels.where("doc_id % 5 = 0")
    got = cotrain.score_quality(docs, seen).join(unseen, "doc_id").collect()
    right = np.mean([r.kept == bool(r.quality) for r in got])
    good_kept = np.mean([r.kept for r in got if r.quality])
    assert right > 0.95 and good_kept > 0.97


def test_odd_rows(spark):
    docs, labels, _ = corpus(random.Random(2), 60)
    docs += [(None, None, None, None, None), (1000, "", "en", "src1", -5), (1001, "w " * 100_000, "en", "src1", 200_000), docs[0]]
    df = spark.createDataFrame([(*d, "c") for d in docs], SCHEMA + ", x string")
    marks = spark.createDataFrame(
        [*labels, (0, 1), (0, 0), (3, None), (None, 1)], "doc_id long, quality int"
    )
    assert cotrain.score_quality(df, marks).count() == len(docs)
    assert cotrain.keep_good(df, marks).columns == df.columns
    none = cotrain.score_quality(df, marks.limit(0)).collect()
    assert all(r.kept and r.p == 0.5 for r in none)
    assert cotrain.score_quality(df.limit(0), marks).count() == 0


def brute(docs, labels, rounds=3, confident=0.95):
    """The same co-training in one process: dictionaries of counts, full-batch Newton steps."""
    votes = {}
    for i, q in labels:
        votes.setdefault(i, []).append(q)
    rows = []
    for i, text, lang, source, n in docs:
        shape, words = cotrain.text_features(text)
        meta = cotrain.meta_features(lang, source, n)
        size = [float(k == meta[2]) for k in range(cotrain.SIZES)]
        y = None if i not in votes else float(np.mean(votes[i]) >= 0.5)
        rows.append((shape, [int(w) for w in words], meta, size, y))
    return rows, votes


def newton(x, y, start, ridge):
    w = np.array(start, dtype=float)
    for _ in range(cotrain.STEPS):
        if not len(x):
            return w
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = ridge * max(len(x), 1.0)
        h = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + pull * w)
        w = w - step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() <= cotrain.TOLERANCE:
            break
    return w


def co_train(rows, folds, rounds, confident):
    n = len(rows)
    labelled = {i: r[4] for i, r in enumerate(rows) if r[4] is not None}

    def odds(examples, slots_of):
        """Log-odds per fold of the slots, from the examples of the other folds."""
        out = []
        for f in range(cotrain.FOLDS):
            mine = [(i, y) for i, y in examples.items() if folds[i] not in (0, f)]
            good = sum(y for _, y in mine)
            bad = len(mine) - good
            seen = {}
            for i, y in mine:
                for s in slots_of(i):
                    seen.setdefault(s, [0, 0])[int(y)] += 1
            table = {}
            for s, (b, g) in seen.items():
                o = 0.0
                if good and bad:
                    t = good + bad
                    o = np.log((g + cotrain.PRIOR * good / t) / good) - np.log((b + cotrain.PRIOR * bad / t) / bad)
                table[s] = (np.float32(o), np.float32(np.log1p(b + g)))
            out.append(table)
        return out

    def text_matrix(tables):
        out = []
        for i, (shape, words, _, _, _) in enumerate(rows):
            t = sum(float(tables[folds[i]].get(w, (0, 0))[0]) for w in words)
            k = max(1, len(words))
            out.append([*np.float32(shape).astype(float), t / k, t / np.sqrt(k) / 5])
        return np.array(out)

    def meta_matrix(tables):
        out = []
        for i, (_, _, meta, size, _) in enumerate(rows):
            s, known = tables[folds[i]].get(meta[0], (0, 0))
            lang = tables[folds[i]].get(meta[1], (0, 0))[0]
            out.append([s, lang, known / 5 * s, 1.0, *size])
        return np.array(out, dtype=float)

    held = [i for i in labelled if folds[i] == 0]
    views = None

    def logits(view):
        x, w, slope, offset = view
        return np.clip(slope * (x @ w) + offset, -15, 15)

    for _ in range(rounds + 1):
        fresh = []
        for kind in (0, 1):
            examples = {i: y for i, y in labelled.items() if folds[i] != 0}
            if views is not None:
                p = 1 / (1 + np.exp(-logits(views[1 - kind])))
                for i in range(n):
                    if i not in labelled and folds[i] != 0 and (p[i] >= confident or p[i] <= 1 - confident):
                        examples[i] = float(p[i] >= 0.5)
            tables = odds(examples, (lambda i: rows[i][1]) if kind == 0 else (lambda i: rows[i][2][:2]))
            x = (text_matrix, meta_matrix)[kind](tables)
            at = list(examples)
            start = np.zeros(x.shape[1]) if views is None else views[kind][1]
            w = newton(x[at], np.array([examples[i] for i in at]), start, cotrain.RIDGE)
            z = np.clip(x[held] @ w, -15, 15)
            line = (1.0, 0.0) if views is None else views[kind][2:]
            slope, offset = newton(np.column_stack((z, np.ones(len(z)))), np.array([labelled[i] for i in held]), line, 1e-4)
            fresh.append((x, w, slope, offset))
        moved = None if views is None else max(np.abs(a[1] - b[1]).max() for a, b in zip(views, fresh))
        views = fresh
        if moved is not None and moved < cotrain.TOLERANCE:
            break
    z = np.column_stack((*(logits(v) for v in views), np.ones(n)))
    mix = newton(z[held], np.array([labelled[i] for i in held]), [1.0, 0.0, 0.0], 1e-4)
    return [1 / (1 + np.exp(-np.clip(c, -30, 30))) for c in (logits(views[0]), logits(views[1]), z @ mix)]


def test_same_as_in_one_process(spark):
    docs, labels, _ = corpus(random.Random(7), 150)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    folds = {r.doc_id: r.f for r in df.select("doc_id", cotrain._fold("doc_id").alias("f")).collect()}
    rows, _ = brute(docs, labels)
    a, b, q = co_train(rows, [folds[d[0]] for d in docs], cotrain.ROUNDS, cotrain.CONFIDENT)
    got = {r.doc_id: r for r in cotrain.score_quality(df, marks).collect()}
    for k, d in enumerate(docs):
        r = got[d[0]]
        assert abs(r.p_text - a[k]) < 1e-4 and abs(r.p_meta - b[k]) < 1e-4 and abs(r.p - q[k]) < 1e-4
        assert r.kept == (q[k] >= 0.5) or abs(q[k] - 0.5) < 1e-4


def test_labels_that_hang_on_words(spark):
    """Shape and metadata say nothing; only the vocabulary does."""
    rng = random.Random(3)
    both = [f"w{k}" for k in range(300)]
    docs, labels, truth = [], [], {}
    for i in range(500):
        good = rng.random() < 0.5
        own = [f"{'g' if good else 'b'}{k}" for k in range(100)]
        words = [rng.choice(own) if rng.random() < 0.15 else rng.choice(both) for _ in range(80)]
        text = " ".join(words)
        docs.append((i, text, "en", "s", 400))
        truth[i] = good
        if i % 2:
            labels.append((i, int(good)))
    got = cotrain.score_quality(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    assert np.mean([r.kept == truth[r.doc_id] for r in got if r.doc_id % 2 == 0]) > 0.9


def test_every_source_has_its_own_weight(spark):
    """Among 200 sources and several languages one of each is bad; texts say nothing."""
    rng = random.Random(5)
    docs, labels, truth = [], [], {}
    for i in range(3000):
        source, lang = f"src{rng.randrange(200)}", rng.choice(["de", "en", "es", "fr"])
        good = not (source in ("src1", "src6", "src10") or (lang == "de" and source > "src5"))
        docs.append((i, "some words that are all the same", lang, source, 30))
        truth[i] = good
        if i % 3:
            labels.append((i, int(good)))
    got = cotrain.score_quality(
        spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    by = {r.doc_id: r.p_meta for r in got}
    bad = np.mean([by[d[0]] for d in docs if d[3] == "src1" and d[2] != "de"])
    fine = np.mean([by[d[0]] for d in docs if d[3] == "src2" and d[2] != "de"])
    assert bad < fine - 0.3
    de = np.mean([by[d[0]] for d in docs if d[2] == "de"])
    es = np.mean([by[d[0]] for d in docs if d[2] == "es"])
    assert de < es - 0.2
    assert len({cotrain.meta_features("x", f"src{k}", 1)[0] for k in range(200)}) >= 199


def test_clashing_names_keep_their_values(spark):
    docs, labels, _ = corpus(random.Random(2), 80)
    names = ("p_text", "p_meta", "p", "kept", "x", "m", "w", "y", "fold", "id")
    schema = SCHEMA + "".join(f", {n} string" for n in names)
    df = spark.createDataFrame([(*d, *(f"{n}{d[0]}" for n in names)) for d in docs], schema)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = cotrain.keep_good(df, marks)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert 0 < len(rows) < 80 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    scored = {r.doc_id: r.kept for r in cotrain.score_quality(df, marks).collect()}
    assert {r.doc_id for r in rows} == {i for i, k in scored.items() if k}


def test_labels_are_joined_in_the_same_way_on_small_tables(spark):
    docs = spark.createDataFrame([(1, 1, "a b", "en", "s", 3)], "id long, fold int, t string, l string, s string, c long")
    marks = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    joined = cotrain._labelled(docs, marks, "doc_id", "quality")
    assert "SortMergeJoin" in plan_of(joined) and "BroadcastHashJoin" not in plan_of(joined)
    assert [r.y for r in joined.collect()] == [1.0]
