import math
import random
from collections import Counter

import pytest

from shelfmark.llm import backoff


def brute(texts, order, alpha):
    docs = [(t or "").split() for t in texts]

    def grams(w, n):
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    total = {n: sum((grams(w, n) for w in docs), Counter()) for n in range(1, order + 1)}
    words = sum(map(len, docs))
    out = []
    for w in docs:
        left = {n: Counter({g: total[n][g] - c for g, c in grams(w, n).items()}) for n in total}
        rest = max(words - len(w), 1)

        def score(g):
            if len(g) == 1:
                return left[1][g] / rest if left[1][g] else alpha / rest
            if left[len(g)][g]:
                return left[len(g)][g] / left[len(g) - 1][g[:-1]]
            return alpha * score(g[1:])

        logs = [math.log(score(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w))]
        out.append((len(w), sum(logs) / len(w) if w else None))
    return out


@pytest.mark.parametrize("order,block_chars", [(3, 300), (2, 10**6), (1, 200), (4, 500)])
def test_equals_brute_force(spark, order, block_chars):
    rng = random.Random(order)
    vocab = ["w%d" % i for i in range(40)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(40)]
    texts += texts[:5] + [None, "", "only", "new words here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = backoff.score_documents(df, order=order, block_chars=block_chars).collect()
    want = brute(texts, order, 0.4)
    assert len(got) == len(texts)
    for r in got:
        n, mean = want[r.doc_id]
        assert r.n_words == n
        assert r.log_score is None if mean is None else math.isclose(r.log_score, mean, rel_tol=1e-9)


def test_many_parts(spark, monkeypatch):
    monkeypatch.setattr(backoff, "PART_GRAMS", 50)
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefgh", k=50)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = backoff.score_documents(df, block_chars=400).collect()
    want = brute(texts, 3, 0.4)
    assert all(math.isclose(r.log_score, want[r.doc_id][1], rel_tol=1e-9) for r in got)


def test_odd_rows(spark):
    rows = [(1, "a b", 1), (1, "a b", 1), (None, "a b", 2), (2, None, 3)]
    df = spark.createDataFrame(rows, "doc_id int, text string, block int")
    got = backoff.score_documents(df).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == [("1", 2), ("1", 2), ("2", 0), ("None", 2)]
    assert len({r.log_score for r in got if r.n_words}) == 1
    assert backoff.score_documents(df.limit(0)).count() == 0


def test_many_repeated_rows_and_a_very_long_text(spark, monkeypatch):
    """Copies of one row go to several blocks; each scores as a document of its own."""
    seen = spark.sparkContext.accumulator(0)
    plain = backoff._words_of_block

    def counted(texts):
        seen.add(1)
        return plain(texts)

    monkeypatch.setattr(backoff, "_words_of_block", counted)
    texts = ["same words in every row of this text"] * 60 + ["other " * 30_000, "same words again"]
    df = spark.createDataFrame([(1 if t.startswith("same words in") else 2, t) for t in texts], "doc_id long, text string")
    got = backoff.score_documents(df.repartition(3), block_chars=300).collect()
    want = brute(texts, 3, 0.4)
    key = lambda r: (r[0], round(r[1], 9))
    assert sorted(key((r.n_words, r.log_score)) for r in got) == sorted(map(key, want))
    # each block is read twice
    assert seen.value >= 2 * 7


def test_pieces_cover_the_sorted_keys():
    import numpy as np

    rng = np.random.default_rng(0)
    for parts in (1, 2, 3, 7, 1000, 10**9):
        keys = np.unique(rng.integers(0, 2**63, 50).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        got = backoff._pieces(keys, parts)
        assert [a for _, a, _ in got] == [0, *(b for _, _, b in got[:-1])] and got[-1][2] == len(keys)
        for p, a, b in got:
            assert all(int(k) * parts >> 64 == p for k in keys[a:b])
        assert len({p for p, _, _ in got}) == len(got)
    assert backoff._pieces(np.zeros(0, dtype=np.uint64), 5) == []
