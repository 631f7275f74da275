import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm import fmindex


def naive(text, items, window):
    words = fmindex.words_of(text)
    hit, found = set(), set()
    for item, phrase in items:
        p = fmindex.words_of(phrase)
        k = min(window, len(p))
        for j in range(len(p) - k + 1 if p else 0):
            for i in range(len(words) - k + 1):
                if words[i : i + k] == p[j : j + k]:
                    hit.update(range(i, i + k))
                    found.add(item)
    return len(words), len(hit), sorted(found)


words = st.lists(st.sampled_from("a b c d é".split()), max_size=30).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(words, max_size=6), st.lists(words, min_size=1, max_size=5), st.integers(1, 5))
def test_shards_equal_naive_search(texts, items, window):
    items = list(enumerate(items))
    folded = [" ".join(w.decode() for w in fmindex.words_of(t)).encode() for t in texts]
    got = fmindex.scan_shard(folded, fmindex.Phrases(items, window))
    for text, (spans, found) in zip(texts, got, strict=True):
        n, hit, want = naive(text, items, window)
        assert sum(b - a for a, b in spans) == hit
        assert found == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60))
def test_suffix_order_rank_and_locate(seq):
    seq = np.array([*seq, 0])
    order = fmindex.suffix_order(seq)
    assert order.tolist() == sorted(range(len(seq)), key=lambda i: seq[i:].tolist())
    w = fmindex.WaveletMatrix(seq, 3)
    for s in range(5):
        at = np.arange(len(seq) + 1)
        want = [int((seq[:i] == s).sum()) for i in at]
        assert w.rank(np.full(len(at), s), at).tolist() == want
    index = fmindex.FMIndex(seq[:-1], 4, sample=3)
    assert index.locate(np.arange(len(seq))).tolist() == order.tolist()


def test_spark_equals_naive(spark, monkeypatch):
    """Several passes of phrases, several shards, hits on word borders, odd rows."""
    rng = random.Random(2)
    vocab = ["w%d" % i for i in range(30)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 14)))) for i in range(12)]
    items += [(3, items[3][1]), (50, ""), (51, None), (None, "w1 w2")]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(0, 60))) for _ in range(40)]
    texts += [f"{texts[0]}, {items[i][1].upper()}! x" for i in range(12)] + [None, "", "..."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[1]), (1, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'z' as spans", "'y' as N_WORDS")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(fmindex, "PHRASE_BYTES", 300)
    monkeypatch.setattr(fmindex, "SHARD_BYTES", 500)
    got = fmindex.find_spans(docs, bench, window=4).collect()
    usable = [(i, t) for i, t in items if i is not None]
    by_text = {r.text: r for r in got}
    assert len(got) == len(rows)
    for _, t in rows:
        n, hit, found = naive(t, usable, 4)
        r = by_text[t]
        assert (r.n_words, sum(b - a for a, b in r.spans), list(r["items"])) == (n, hit, found)
    cut = fmindex.decontaminate(docs, bench, window=4)
    assert cut.columns == docs.columns
    for r in cut.collect():
        assert r.spans == "z"
        if r.text is not None:
            before = next(t for i, t in rows if i == r.doc_id and t is not None)
            if not by_text[before].spans:
                assert r.text == before
    empty = fmindex.find_spans(docs.limit(0), bench)
    assert empty.count() == 0
    none = fmindex.find_spans(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and all(r.spans == [] and r.items == [] for r in none)
    assert {r.n_words for r in none} == {r.n_words for r in fmindex.find_spans(docs, bench).collect()}


def test_cut_spans_and_size(spark):
    text = "Keep this. One two  three, four! And  this."
    assert fmindex.cut_spans(text, [[2, 6]]) == "Keep this. ! And  this."
    assert fmindex.cut_spans("éa bé", [[0, 2]]) == ""
    docs = spark.createDataFrame([(1, text, 43), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(9, "one two three four")], "item_id long, text string")
    got = {r.doc_id: r for r in fmindex.decontaminate(docs, bench, size_col="n_chars").collect()}
    assert got[1].n_chars == len(got[1].text) < 43
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].n_chars) == ("clean", 5, None, None)


def test_one_long_text_with_repeats():
    block = b"a b c d e f g h i j k l " * 4000
    phrases = fmindex.Phrases([(1, "c d e f g h i j k l a b")], 10)
    ((spans, items),) = fmindex.scan_shard([block], phrases)
    assert items == [1] and spans[0][0] == 2
