import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark.llm import audit
from shelfmark.llm.audit import audit_filters, interactions

DOCS = "doc_id long, text string, lang string"
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, part in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        got = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > least[t],
        }
        out.append((i, part or "", {k for k, v in got.items() if v}))
    return out


def brute(rows, labels, letters="ABCDE"):
    """Every order run over every document."""
    failed = failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = {}
    for part in {p for _, p, _ in failed}:
        mine = [(i, f) for i, p, f in failed if p == part]
        shapley = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                shapley[x] += len(removed)
                out[part, "".join(order), step] = [
                    len(left), len(removed), sum(x in f for _, f in mine) - len(removed),
                    sum(f == {x} for _, f in mine), sum(i in good for i, _ in removed),
                    sum(i in toxic for i, _ in removed),
                ]
        for (p, order, step), counts in out.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got_of(df):
    rows = df.collect()
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        few = rng.random() < 0.3
        words = rng.choices([f"w{k}" for k in range(40 if few else 2000)], k=rng.choice([3, 99, 100, 150]))
        text = " ".join(words)
        if rng.random() < 0.2:
            text = text.upper()
        if rng.random() < 0.2:
            text += rng.choice(["#", " $", "%", "&", "*", "|"])
        rows.append((i, text, rng.choice(["en", "de", None, ""])))
    rows += [(n + k, rows[k % 7][1], rows[k % 5][2]) for k in range(60)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, n + 60, 2)]
    return rows, labels


def test_equals_brute_force(spark):
    rows, labels = corpus(150)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = got_of(audit_filters(docs, spark.createDataFrame(labels, LABELS)))
    assert got == brute(rows, labels)
    assert len(got) == 3 * 120 * 5


def test_hot_copies_are_salted(spark):
    rows, labels = corpus(40, seed=3)
    rows += [(1000 + k, "the same", "en") for k in range(200)] + [(5000 + k, None, "de") for k in range(90)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = got_of(audit_filters(docs, spark.createDataFrame(labels, LABELS), salt_rows=20))
    assert got == brute(rows, labels)


def test_odd_rows(spark):
    rows = [
        (None, None, None), (None, "x", "en"), (1, "x", "en"), (1, "x", "en"), (2, "x", "en"), (3, "", None),
        (4, None, ""), (5, "word " * 300_000, "en"), (6, "\x0b\x0c", "en"), (7, "ABC", "en"), (8, "É#", "en"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (1, 1, 1), (None, 1, 1), (2, None, None), (99, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, LABELS)
    want = brute(rows, labels)
    assert got_of(audit_filters(docs, marks)) == want
    extra = docs.select("*", F.lit(1).alias("failed"), F.lit("z").alias("part"), F.lit(2).alias("id"), F.lit(0).alias("n"))
    more = marks.select("*", F.lit("q").alias("text"), F.lit("q").alias("id"), F.lit(7).alias("good"))
    assert got_of(audit_filters(extra, more)) == want
    assert audit_filters(docs.limit(0), marks).collect() == []
    none = got_of(audit_filters(docs, marks.limit(0)))
    assert all(v[4] == v[5] == 0 for v in none.values()) and none.keys() == want.keys()


def test_own_filters(spark):
    rows = [(i, "a" * i, "p") for i in range(10)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([], LABELS)
    n = F.length("text")
    got = got_of(audit_filters(docs, labels, filters={"x": n < 4, "y": n < 2}, copy=None))
    assert got["p", "xy", 1][:4] == (6, 4, 0, 2) and got["p", "xy", 2][:4] == (6, 0, 2, 0)
    assert got["p", "yx", 1][:4] == (8, 2, 0, 0) and got["p", "yx", 2][:4] == (6, 2, 2, 2)
    assert got["p", "xy", 1][6] == 6 and got["p", "yx", 1][6] == 2
    with pytest.raises(ValueError):
        interactions(docs, "AA")
    with pytest.raises(ValueError):
        interactions(docs, "")


def test_many_parts_pass_the_row_limit(spark):
    """Prefixes times parts go beyond the limit that Spark sets to recursion."""
    n = 3_200
    cells = spark.range(n).select(
        F.col("id").cast("string").alias("part"),
        F.array(F.struct(F.lit(3).alias("mask"), (F.col("id") + 1).alias("n"), F.lit(1).alias("good"), F.lit(0).alias("toxic"))).alias("cells"),
    )
    cells = cells.withColumn("cells", F.col("cells").cast("array<struct<mask:int,n:bigint,good:bigint,toxic:bigint>>"))
    got = interactions(cells, audit.COPY + "ABCD")
    assert got.count() == n * 600
    first = got.where("part = '41' and filter_order = 'EABCD'").orderBy("step").collect()
    assert [(r.kept, r.removed, r.redundant) for r in first[:2]] == [(0, 42, 0), (0, 0, 42)]
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"


def test_plan_has_no_cross_join(spark):
    rows, labels = corpus(20)
    df = audit_filters(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    df.collect()
    assert "NestedLoop" not in plan_of(df) and "Cartesian" not in plan_of(df)
