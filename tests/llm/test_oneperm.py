import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark.llm import oneperm
from shelfmark.llm.oneperm import BINS, PROBES, fingerprint, fingerprint_documents, likeness, with_next
from shelfmark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
BLANKS = re.compile("[ \\x09-\\x0D]+")
LOWER = str.maketrans(oneperm.UPPER, oneperm.LOWER)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def hash_of(*values, seed=42):
    """Spark's xxhash64 of longs, ints and strings: each seeds the next."""
    for kind, v in values:
        if kind == "s":
            seed = xxhash.xxh64_intdigest(v.encode(), seed)
        else:
            seed = xxhash.xxh64_intdigest((v % (1 << 8 * kind)).to_bytes(kind, "little"), seed)
    return signed(seed)


def words_of(text):
    return [w for w in BLANKS.split(text.translate(LOWER)) if w]


def shingles(text, width=5):
    words = words_of(text)
    runs = [words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else []
    return {tuple(r) for r in runs}


def brute_print(text):
    """Bins, donors and bits as plain loops."""
    low = 64 - (BINS.bit_length() - 1)
    hashes = {hash_of(*[(8, hash_of(("s", w))) for w in s]) for s in shingles(text)}
    if not hashes:
        return ""
    minima = [None] * BINS
    for h in hashes:
        b = (h >> low) + BINS // 2
        if minima[b] is None or h < minima[b]:
            minima[b] = h
    filled = [b for b in range(BINS) if minima[b] is not None]
    out = []
    for j, h in enumerate(minima):
        if h is None:
            tries = [hash_of((4, j), (4, t)) & (BINS - 1) for t in range(1, PROBES + 1)]
            order = sorted(filled, key=lambda b: (hash_of((4, j), (8, b)) & -BINS) | b)
            donor = next(b for b in [*tries, order[0]] if minima[b] is not None)
            h = hash_of((8, minima[donor]), (4, j))
        out.append(f"{h & 15:X}")
    return "".join(out)


def brute_likeness(a, b):
    if not a or not b:
        return float(a == b)
    share = sum(x == y for x, y in zip(a, b, strict=True)) / BINS
    return max(0.0, (share - 1 / 16) / (1 - 1 / 16))


def test_registered_query_equals_brute_force(spark):
    import hashlib

    got = {r.doc_id: r for r in QUERIES["op12_document_fingerprints"](spark, SF_DIR).collect()}
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet' ORDER BY 1 DESC").fetchall()
    assert len(got) == len(docs)
    prints = [brute_print(t) for _, t in docs]
    off = []
    for k, (doc_id, text) in enumerate(docs):
        follower = docs[(k + 1) % len(docs)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + follower[:cut]
        r, want = got[doc_id], brute_print(edited)
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (prints[k], want)
        assert r.near_edited == pytest.approx(brute_likeness(prints[k], want))
        assert r.near_next == pytest.approx(brute_likeness(prints[k], prints[(k + 1) % len(docs)]))
        a, b = shingles(text), shingles(edited)
        if len(a) > 20:
            off.append(r.near_edited - len(a & b) / len(a | b))
    assert abs(np.mean(off)) < 0.01 and np.abs(off).max() < 0.12


def test_likeness_follows_jaccard(spark):
    rng = random.Random(5)
    rows, true = [], []
    for share in (0.0, 0.2, 0.5, 0.8, 0.95, 1.0):
        for size in (12, 60, 300, 3000):
            a = [f"w{rng.random()}" for _ in range(size)]
            b = a[: int(size * share)] + [f"v{rng.random()}" for _ in range(size - int(size * share))]
            x, y = " ".join(a), " ".join(b)
            rows.append((x, y))
            p, q = shingles(x), shingles(y)
            true.append(len(p & q) / len(p | q))
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b")))).collect()]
    for (x, _), g, t in zip(rows, got, true, strict=True):
        assert abs(g - t) < (0.35 if len(words_of(x)) < 20 else 0.13)
    assert all(g == 1 for g, t in zip(got, true, strict=True) if t == 1)


def test_odd_texts(spark):
    long = "ab " * 400_000
    texts = ["", None, " \t\n", "one", "ONE", "a b c d", "a b c d e", "A  b\tc\nd\x0be", long, " ", "É é 😀"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = [r.fingerprint for r in fingerprint_documents(df).orderBy("i").collect()]
    assert got[0] == got[1] == got[2] == []
    assert got[3] == got[4] and got[6] == got[7] and len(got[3]) == BINS // 16
    as_hex = [r[0] for r in fingerprint_documents(df).orderBy("i").select(oneperm.as_hex(F.col("fingerprint"))).collect()]
    assert as_hex == [brute_print(t or "") for t in texts]
    pairs = df.where("i < 2").alias("x").crossJoin(df.where("i in (0, 3)").alias("y"))
    near = pairs.select(likeness(fingerprint(F.col("x.text")), fingerprint(F.col("y.text")))).collect()
    assert sorted(r[0] for r in near) == [0.0, 0.0, 1.0, 1.0]


def test_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "x", 3)], "doc_id long, text string, fingerprint string, print int")
    (row,) = fingerprint_documents(df).collect()
    assert row.print == 3 and len(row.fingerprint) == BINS // 16
    assert fingerprint_documents(df.limit(0)).collect() == []
    assert with_next(df.limit(0)).collect() == []
    (row,) = with_next(df).collect()
    assert row.next_head == "a" and row.next_print == row.print


def test_order_with_repeats_nulls_and_salts(spark):
    rows = [(5, "five five five"), (3, "three"), (3, "three"), (3, "tres!!"), (None, "lost"), (None, None), (9, None)]
    rows += [(3, "three")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    threes = ["three", "tres!!"]
    first = min(threes, key=lambda t: hash_of(("s", t)))
    follower = {9: "five five five", 5: first, 3: ""}
    for salt_rows in (1_000_000, 5):
        got = with_next(df, salt_rows=salt_rows).collect()
        assert sorted(r.text for r in got) == sorted(t or "" for _, t in rows)
        for r in got:
            assert r.n_chars == len(r.text)
            if r.id is None:
                assert r.next_head is None and r.next_print is None
            else:
                assert r.next_head == follower[r.id][: len(r.text) // 3]


def test_no_python_and_one_text_shuffle(spark):
    df = QUERIES["op12_document_fingerprints"](spark, SF_DIR)
    plan = plan_of(df)
    assert "ArrowEval" not in plan and "Python" not in plan and "MapIn" not in plan
    df.collect()
    assert "ReusedExchange" in plan_of(df) or plan_of(df).count("Scan parquet") >= 1
