"""Suggestions and keywords for many terms, judged pairs, extra fields, wide previews."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark.operators import catalog, embed
from shelfmark.plans import evaluation
from shelfmark.queries import QUERIES
from shelfmark.sources import envelopes, files

# ── many terms ──────────────────────────────────────────────────────────────────


def brute_suggest(titles, terms, n):
    return {
        (t, k + 1): s
        for t in {t for t in terms if t is not None}
        for k, s in enumerate(sorted({s for s in titles if s is not None and t.lower() in s.lower()})[:n])
    }


def test_suggest_many_equals_contains(spark, monkeypatch):
    monkeypatch.setattr("shelfmark.operators.groups.SALT_ROWS", 5)
    rng = random.Random(1)
    titles = ["".join(rng.choices("abAB é", k=rng.randint(0, 9))) for _ in range(120)] + [None, "", "a", "aaaa aaaa"]
    terms = ["a", "AB", "ab", "aba", "b a", "é", "zz", "abab", "", None, "aaaa aaaa", "aaaa aaaa b", " "]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    asked = spark.createDataFrame([(t,) for t in terms * 2], "part string")
    got = {(r.term, r["rank"]): r.suggestion for r in catalog.suggest_many(df, asked, "title", "part", 4).collect()}
    assert got == brute_suggest(titles, terms, 4)
    for t in ("ab", "", "zz"):
        one = [r.suggestion for r in catalog.auto_suggest(df.dropna(), t, "title", 4).collect()]
        assert one == [got[t, k] for k in range(1, 5) if (t, k) in got]
    assert catalog.suggest_many(df.limit(0), asked, "title", "part").collect() == []
    assert catalog.suggest_many(df, asked.limit(0), "title", "part").collect() == []


def test_match_keywords_equals_one_by_one(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["Red", "ring", "redder", "x", ""], k=4)), rng.choice([None, "src"])) for i in range(40)]
    keywords = {1: "red RING", 2: "red red", 3: "  ", 4: "nothing here", 5: "src x ing"}
    df = spark.createDataFrame(rows, "id long, a string, b string")
    asked = spark.createDataFrame(list(keywords.items()), "key long, keyword string")
    got = {(r.key, r.id): (r.relevance, r.weight) for r in catalog.match_keywords(df, asked, ["a", "b"]).collect()}
    texts = {i: f"{a} {b}".lower() if b else a.lower() for i, a, b in rows}
    want = {}
    for key, keyword in keywords.items():
        for i, t in texts.items():
            found = {x for x in keyword.lower().split() if x in t}
            if found:
                counts = [sum(x in u for u in texts.values()) for x in found]
                weight = sum(math.log(1 + (len(texts) - n + 0.5) / (n + 0.5)) for n in counts)
                want[key, i] = (len(found), pytest.approx(weight))
    assert got == want
    one = {r.id: r.relevance for r in catalog.match_keyword(df, "red RING", "a", "b").collect()}
    assert one == {i: n for (k, i), (n, _) in got.items() if k == 1}


@pytest.mark.parametrize("cells", [1, 2_000_000])
def test_best_by_keywords_are_the_first_matches(spark, monkeypatch, cells):
    rng = random.Random(4)
    words = ["Red", "ring", "redder", "x", "", "a\u00a0b", "größe", "b\tring"]
    rows = [(f"i{i}", " ".join(rng.choices(words, k=4)), rng.choice([None, "src"])) for i in range(200)]
    keywords = {1: "red RING", 2: "red red", 3: "  ", 4: "nothing here", 5: "src x ing", 6: "a\u00a0b größ x", 7: None}
    df = spark.createDataFrame(rows, "id string, a string, b string").repartition(3)
    asked = spark.createDataFrame(list(keywords.items()), "key long, keyword string")
    monkeypatch.setattr(catalog, "BLOCK_CELLS", cells)
    best = catalog.best_by_keywords(df, asked, ["a", "b"], 7)
    got = {(r.key, r["rank"]): (r.id, r.relevance, pytest.approx(r.weight)) for r in best.collect()}
    every = {}
    for r in catalog.match_keywords(df, asked, ["a", "b"]).collect():
        every.setdefault(r.key, []).append((-r.relevance, -round(r.weight, 6), r.id, r.weight))
    want = {
        (key, n + 1): (i, -relevance, weight)
        for key, found in every.items()
        for n, (relevance, _, i, weight) in enumerate(sorted(found)[:7])
    }
    assert set(every) == {1, 2, 5, 6} and {k: got[k] for k in got} == want


def test_keyword_query_moves_no_matches(spark):
    # only the best rows of each task travel to their key
    plan = plan_of(QUERIES["match_keywords"](spark, "/root/testdata/sf0.001"))
    assert "MapInArrow" in plan and "SortMergeJoin" not in plan and "HashAggregate" not in plan


# ── a judge that is called ──────────────────────────────────────────────────────


def test_failed_prompts_are_asked_again(spark):
    calls = spark.sparkContext.accumulator(0)
    pairs = spark.createDataFrame(
        [(1, "p1", True), (2, "p2", True), (3, "p1", False), (4, "bad", True), (5, "odd", None), (6, None, None)],
        "pair int, prompt string, needs_llm_label boolean",
    )

    def judge(fails):
        def fn(prompts):
            calls.add(len(prompts))
            if any(p in fails for p in prompts):
                raise TimeoutError("busy")
            return ["what?" if p == "odd" else json.dumps({"similar": True, "joinable": p == "p2", "reasoning": p}) for p in prompts]

        return fn

    one = evaluation.judge_pending(pairs, None, judge({"bad", "p2"}), 2)
    assert {r.error is None for r in one.collect()} == {True, False} and one.count() == 4
    before = calls.value
    two = evaluation.judge_pending(pairs, one, judge({"bad"}), 2)
    got = {r.pair: r for r in evaluation.judged(pairs, two, "judge").collect()}
    # only the two that had failed: together, then one by one where that batch fails
    assert calls.value - before <= 4
    assert got[1].reasoning == got[3].reasoning == "p1" and not got[1].joinable
    assert got[2].joinable and got[2].label_source == "judge"
    assert (got[4].similar, got[4].joinable, got[4].reasoning) == (False, False, "Error: TimeoutError: busy")
    assert (got[5].similar, got[5].reasoning) == (False, "Error: unreadable judgment")
    assert got[6].label_source is None and got[6].similar is None
    assert "needs_llm_label" not in got[1].asDict()


def test_embedding_results_in_any_form(spark):
    df = spark.createDataFrame([("a",), ("bb",)], "text string").coalesce(1)

    def indexed(texts):
        return [{"index": i, "embedding": [len(t), 0.5]} for i, t in reversed(list(enumerate(texts)))]

    assert [r.vector for r in embed.embed(df, "text", indexed).collect()] == [[1.0, 0.5], [2.0, 0.5]]
    short = embed.embed(df, "text", lambda texts: [[1.0]][: len(texts)]).collect()
    assert [r.vector for r in short] == [[1.0], [1.0]] and all(r.error is None for r in short)
    none = embed.embed(df, "text", lambda texts: []).collect()
    assert all(r.vector is None and "0 results for 1 texts" in r.error for r in none)


# ── fields outside the schema ───────────────────────────────────────────────────


@pytest.mark.parametrize("whole", [True, False])
def test_extra_fields_survive(spark, tmp_path, whole):
    rows = [
        {"id": "a", "name": "A", "views_count": 3, "licence": "x", "nested": {"k": [1, 2]},
         "categories": [{"category_id": 1, "slug": "s"}], "organization": {"organization_id": 7}},
        {"id": "b", "views_count": "many", "licence": 5},
        {"id": "", "licence": "no id"},
        {"name": "no id"},
    ]
    text = json.dumps(rows) if whole else "\n".join(map(json.dumps, rows))
    (tmp_path / "c.json").write_text(text, encoding="utf-8")
    plain = files.read_catalog(spark, str(tmp_path), whole_file=whole)
    kept = files.read_catalog(spark, str(tmp_path), whole_file=whole, extras="raw")
    assert kept.drop("raw").schema == plain.schema
    named = files.extra_fields(kept, "raw", "licence string, nested struct<k:array<int>>, absent int")
    got = {r.id: r for r in named.collect()}
    assert got.keys() == {"a", "b"}
    assert (got["a"].licence, got["a"].nested.k, got["a"].absent) == ("x", [1, 2], None)
    assert got["a"].views_count == 3 and got["a"].categories[0].slug == "s" and got["a"].organization.organization_id == 7
    assert (got["b"].licence, got["b"].nested, got["b"].views_count) == ("5", None, None)
    with pytest.raises(ValueError):
        files.read_catalog(spark, str(tmp_path), fmt="parquet", extras="raw")


def test_wide_preview_of_changing_fields(spark):
    bodies = [
        (1, '{"data":{"results":[{"year":2024,"value":1.5},{"year":2025}]}}'),
        (2, '{"data":{"results":[{"year":2023,"a b\'s":"x","id":9,"mixed":1}, 7, {"mixed":"t"}]}}'),
        (3, '{"data":{}}'), (4, "no json"), (5, None),
    ]
    rows = envelopes.preview_values(spark.createDataFrame(bodies, "id int, raw string"))
    wide = envelopes.wide_preview(rows)
    assert wide.columns == ["id", "pos", "a b's", "id_field", "mixed", "value", "year"]
    got = {(r.id, r.pos): r for r in wide.withColumn("mixed", F.col("mixed").cast("string")).collect()}
    assert len(got) == 5
    assert (got[1, 0].year, float(got[1, 0].value), got[1, 1].value) == (2024, 1.5, None)
    assert (got[2, 0]["a b's"], got[2, 0].id_field, got[2, 0].mixed, got[2, 2].mixed) == ("x", 9, "1", "t")
    assert got[2, 1].year is None
    assert envelopes.wide_preview(rows.limit(0)).columns == ["id", "pos"]
