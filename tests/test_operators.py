import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from shelfmark import schemas
from shelfmark.operators import catalog, quality, rank, upsert
from shelfmark.operators.embed import embed, hash_embed
from shelfmark.operators.readings import latest_per_key, rates_of_day, typed_numbers
from shelfmark.plans import evaluation, records, search
from shelfmark.plans import similar as sim


def test_global_rank_numbers_every_row(spark):
    df = spark.range(5000).select("id", (F.col("id") % 7).alias("v")).repartition(8)
    ranked = rank.global_rank(df, [F.col("v").desc(), F.col("id")])
    got = [r.id for r in ranked.orderBy("rank").collect()]
    assert got == sorted(range(5000), key=lambda i: (-(i % 7), i))


def test_deep_pages(spark, monkeypatch):
    df = spark.range(500).repartition(4)
    shallow = [r.id for r in rank.paginate(df, [F.col("id")], 3, 20).collect()]
    monkeypatch.setattr(rank, "PREFIX_ROWS", 10)
    deep = sorted(r.id for r in rank.paginate(df, [F.col("id")], 3, 20).collect())
    assert shallow == deep == list(range(40, 60))
    with pytest.raises(ValueError):
        rank.paginate(df, [F.col("id")], 1, 201, rank.MAX_PREVIEW_PAGE)
    assert rank.page_envelope(df, 3, 20).first().total_pages == 25


def test_unknown_sort_is_refused():
    with pytest.raises(ValueError):
        rank.catalog_order("OLDEST")


def test_last_wins_is_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "id int, o int, v string")
    once = rank.last_wins(df, ["id"], "o")
    assert sorted(r.v for r in once.collect()) == ["b", "c"]
    assert sorted(rank.last_wins(once, ["id"], "o").collect()) == sorted(once.collect())


def test_sample_for_labels_without_crossing_pairs(spark):
    df = spark.createDataFrame([(i, i + 1, 0.5 + i / 100, True) for i in range(5)], "dataset_a_id int, dataset_b_id int, jaccard_score double, same_category boolean")
    assert [r.dataset_a_id for r in rank.sample_for_labels(df, 2).collect()] == [4, 3]
    mixed = df.withColumn("same_category", F.col("dataset_a_id") != 0)
    assert [r.dataset_a_id for r in rank.sample_for_labels(mixed, 2).collect()] == [0]


def test_merge_retries_errors_and_keeps_new(spark):
    s = "id string, columns array<string>, error string"
    done = spark.createDataFrame([("a", ["x"], None), ("b", None, "timeout"), ("c", None, "")], s)
    todo = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    assert sorted(r.id for r in upsert.pending(todo, done).collect()) == ["b", "d"]
    new = spark.createDataFrame([("b", ["y"], None), ("d", None, "gone")], s)
    merged = {r.id: (r.columns, r.error) for r in upsert.merge_runs(done, new).collect()}
    assert merged == {"a": (["x"], None), "b": (["y"], None), "c": (None, ""), "d": (None, "gone")}
    status = {r.status: r.n for r in catalog.fetch_status_counts(upsert.merge_runs(done, new)).collect()}
    assert status == {"with_columns": 2, "no_column_data": 1, "error": 1}


def test_updated_since_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01",), ("2024-03-01",), (None,), ("soon",)], "updated_at string")
    assert [r[0] for r in upsert.updated_since(df, "2024-02-01").collect()] == ["2024-03-01"]
    path = str(tmp_path / "t")
    df.select(F.col("updated_at").try_cast("timestamp").alias("updated_at")).write.parquet(path)
    plan = plan_of(upsert.updated_since(spark.read.parquet(path), "2024-02-01"))
    assert "GreaterThan(updated_at" in plan


def test_split_valid_with_corrupt_lines(spark):
    raw = spark.createDataFrame(
        [('{"id":1,"created_at":"2024-01-01T00:00:00"}',), ('{"id":"x","created_at":"2024-01-01T00:00:00"}',), ('{"id":3}',), ("junk",)],
        "raw string",
    )
    typed = quality.typed_lines(raw, schemas.INDEX_SNAPSHOT)
    good, bad = quality.split_valid(typed, quality.required(*schemas.REQUIRED["index_snapshot"]))
    assert [r.id for r in good.collect()] == [1]
    errors = {r.raw: [e["loc"] for e in r.errors] for r in bad.collect()}
    assert errors['{"id":3}'] == ["created_at"] and "id" in errors["junk"] and len(errors) == 3


def test_submissions(spark):
    rows = [
        (" Ann ", "Lee", "ann@example.com", "012345678", "Hi"),
        ("  ", "Lee", "not a mail", "1234567", "Hi"),
        ("Ann", None, "a@b.c", "1" * 16, " "),
        ("Ann", "Lee", "a@example.org", "1" * 15, "x"),
    ]
    got = quality.validate_submissions(spark.createDataFrame(rows, schemas.SUBMISSION)).collect()
    assert [[e["loc"] for e in r.errors] for r in got] == [
        [], ["first_name", "email", "phone"], ["last_name", "message", "phone"], [],
    ]
    assert got[0].first_name == "Ann"


def test_key_status(spark):
    asked = spark.createDataFrame([("USD",), ("THB",), ("XXX",)], "currency_id string")
    have = spark.createDataFrame([("USD", 1)], "currency_id string, id int")
    got = {r.currency_id: (r.status, r.error_name, r.error_msg) for r in quality.key_status(asked, have, "currency_id", "exchange_rate").collect()}
    assert got == {
        "USD": (200, None, None),
        "THB": (404, "REAL_TIME_API_DATA_NOT_FOUND", "There is no today rate for this currency yet."),
        "XXX": (400, "ERROR_PARAMS", "Invalid currency_id"),
    }
    assert quality.feed_status(have.limit(0), "exchange_rate").first().error_msg == "There is no today rate yet."
    assert quality.feed_status(have, "csx_index").first().status == 200
    assert len(schemas.CURRENCIES) == 24 and len(schemas.PROVINCES) == 25


def test_latest_and_rates(spark):
    rows = [(1, "USD", "2024-01-01", 1), (2, "USD", "2024-01-02", 1), (3, "USD", "2024-01-02", 1), (4, "THB", "2024-01-01", 5)]
    df = spark.createDataFrame(rows, "id int, currency_id string, d string, h int").select(
        "id", "currency_id", F.col("d").cast("date").alias("valid_date"), F.make_timestamp(F.lit(2024), F.lit(1), F.lit(1), "h", F.lit(0), F.lit(0)).alias("created_at")
    )
    assert {(r.currency_id, r.id) for r in latest_per_key(df, ["currency_id"], "created_at").collect()} == {("USD", 3), ("THB", 4)}
    assert [(r.currency_id, r.id) for r in rates_of_day(df, "2024-01-02").collect()] == [("USD", 3)]
    n = typed_numbers(spark.createDataFrame([("1,5",)], "volume string"), "volume").first()
    assert n.volume == "1,5" and n.volume_number == 15.0


def test_search_arguments(spark):
    df = spark.createDataFrame(
        [(1, "Rice", "trade of rice", ["trade", "farm"], 9, "CSV"), (2, "Wheat", None, ["farm"], 9, None), (3, "Tax", "money", [], None, "xlsx")],
        "id int, name string, description string, category_slugs array<string>, organization_id int, format string",
    )

    def ids(**a):
        return sorted(r.id for r in catalog.search_catalog(df, page=None, **a).collect())

    assert ids() == [1, 2, 3]
    assert ids(categories="trade,farm") == [1, 2]
    assert ids(categories="") == []
    assert ids(organizations="9") == [1, 2]
    assert ids(formats="csv,XLSX") == [1, 3]
    assert ids(keyword="rice money") == [1, 3]
    assert [r.id for r in catalog.filter_format(df, "csv").collect()] == [1]


def test_details_and_articles(spark):
    df = spark.createDataFrame(
        [("1", "rice", "Rice", "ស្រូវ", "d", None), ("2", "tax", "Tax", "", None, None)],
        "id string, slug string, title_en string, title_kh string, description_en string, description_kh string",
    )
    assert catalog.dataset_detail(df, "rice", "km").first().title == "ស្រូវ"
    assert catalog.dataset_detail(df, "2", "km").first().title == "Tax"
    assert catalog.dataset_detail(df, "1").first().title == "Rice"
    assert catalog.dataset_detail(df, "zzz").count() == 0
    keys = spark.createDataFrame([("1",), ("tax",), ("tax",), ("zz",)], "key string")
    assert {(r.key, r.id) for r in catalog.dataset_details(df, keys).collect()} == {("1", "1"), ("tax", "2")}
    news = spark.createDataFrame(
        [("1", "s1", "A", None, "blog", "2024-01-01"), ("2", "s2", "B", None, "blog", "2024-02-01"), ("3", "s3", "C", None, "events_and_news", None)],
        "id string, slug string, title_en string, title_kh string, category string, created_at string",
    )
    assert [r.id for r in catalog.list_articles(news).collect()] == ["2", "1", "3"]
    assert [r.id for r in catalog.list_articles(news, "blog", order_by="asc", sort_by="title_en").collect()] == ["1", "2"]
    assert catalog.article_detail(news, "s2").first().id == "2"


def test_suggest(spark):
    df = spark.createDataFrame([("Rice",), ("Rice",), ("Price list",), ("Tax",)], "title string")
    assert [r[0] for r in catalog.auto_suggest(df, "RICE", "title").collect()] == ["Price list", "Rice"]
    assert catalog.auto_suggest(df, "", "title").count() == 3


def test_facets_count_a_dataset_once(spark):
    df = spark.createDataFrame([(1, ["a", "b", "a"], "o", "CSV"), (2, ["a"], None, None), (3, None, "o", "CSV")], "id int, c array<string>, o string, f string")
    got = {(r.facet, r.value): r.dataset_count for r in catalog.facet_counts(df, "id", "c", "o", "f").collect()}
    assert got == {("category", "a"): 2, ("category", "b"): 1, ("organization", "o"): 2, ("format", "CSV"): 2}


# ── embedding ───────────────────────────────────────────────────────────────────


def test_embed_retries_one_by_one(spark):
    def flaky(texts):
        if len(texts) > 1 and any("bad" in t for t in texts):
            raise RuntimeError("batch refused")
        if "bad" in texts[0]:
            raise ValueError("no vector for this")
        # Answers come back out of order, with their index.
        return [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in reversed(list(enumerate(texts)))]

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "bb", "bad", "cccc", "d"])], "id int, t string").coalesce(1)
    got = {r.id: (r.vector, r.error) for r in embed(df, "t", flaky, 2).collect()}
    assert got[0] == ([1.0, 1.0], None) and got[1] == ([2.0, 1.0], None) and got[3] == ([4.0, 1.0], None)
    assert got[2] == (None, "ValueError: no vector for this")


def test_index_datasets_resumes(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(texts):
        calls.add(len(texts))
        return [[float(len(t))] for t in texts]

    stored = spark.createDataFrame([], "id string, vector array<float>, payload string, profile_hash string, error string")
    profiles = spark.createDataFrame([("a", "x"), ("b", "yy")], "id string, profile string")
    payload = profiles.select("id", F.upper("id").alias("payload"))
    stored = search.index_datasets(profiles, payload, stored, fn)
    stored = spark.createDataFrame(stored.collect(), stored.schema)
    assert calls.value == 2 and {r.id: r.vector for r in stored.collect()} == {"a": [1.0], "b": [2.0]}
    changed = spark.createDataFrame([("a", "x"), ("b", "zzz"), ("c", "w")], "id string, profile string")
    again = {r.id: r.vector for r in search.index_datasets(changed, payload, stored, fn).collect()}
    assert calls.value == 4 and again == {"a": [1.0], "b": [3.0], "c": [1.0]}
    by_id = {r.id: r.vector for r in search.index_datasets(changed, payload, stored, fn, key="id").collect()}
    assert by_id["b"] == [2.0] and calls.value == 5


def test_index_columns_and_column_keys(spark):
    cols = spark.createDataFrame(
        [("a", [("ref_year", "when"), ("x_kh", None)]), ("b", [("Year", None)])],
        "id string, columns array<struct<title:string,description:string>>",
    )
    points = search.index_columns(cols, lambda ts: [[1.0, float(len(t))] for t in ts])
    rows = {r.title: r for r in points.collect()}
    assert set(rows) == {"ref_year", "Year"} and rows["ref_year"].semantic_string == "ref_year: when"
    normal = search.column_similarity(points, 0.5)
    assert {r.name for r in normal.names.collect()} == {"year"}
    raw = search.column_similarity(points, 0.5, key="raw")
    assert {r.name for r in raw.names.collect()} == {"ref_year", "Year"}


def test_hash_embed_is_unit_length(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "c")], "id int, t string")
    got = hash_embed(df, "id", F.split("t", " "), 16).collect()
    assert all(abs(sum(x * x for x in r.vector) - 1) < 1e-9 and len(r.vector) == 16 for r in got)


def test_search_and_neighbors(spark):
    schema = "id string, vector array<float>, payload struct<name:string,category:string,org:string>"
    store = spark.createDataFrame([("a", [1.0, 0.0], ("A", "c", "o")), ("b", [1.0, 0.2], ("B", "c", "o")), ("z", [0.0, 1.0], ("Z", "d", "p"))], schema)
    recs = spark.createDataFrame([("a", "Title A"), ("b", "Title B")], "id string, title string")
    asked = spark.createDataFrame([("q", "x")], "id string, text string")
    hits = search.search_text(asked, store, lambda ts: [[1.0, 0.0] for _ in ts], 2, 0.5).orderBy("rank").collect()
    assert [(r.id, r.payload.name) for r in hits] == [("a", "A"), ("b", "B")]
    near = {(r.target_id, r["rank"]): r.title for r in search.neighbors(store, recs, 2).collect()}
    assert near[("a", 1)] == "Title B" and near[("a", 2)] == "Z"
    assert search.embedding_only(store, recs, 2).where("target_id = 'a'").count() == 1
    assert search.embedding_only(store, recs, 1, overfetch=1).where("target_id = 'z'").count() == 1


# ── judging ─────────────────────────────────────────────────────────────────────


def test_judgments(spark):
    rows = [('{"similar": true, "joinable": false, "reasoning": "r"}',), ("oops",), (None,), ('{"similar": true}',)]
    got = spark.createDataFrame(rows, "a string").select(evaluation.parse_judgment("a").alias("j")).select("j.*").collect()
    assert [(r.similar, r.joinable) for r in got] == [(True, False), (False, False), (False, False), (True, False)]
    assert got[1].reasoning.startswith("Error")


def test_labels_replace_pair_fields(spark):
    pairs = spark.createDataFrame([(1, 2, "T1", "T2", 0.7, ["a"], False, True, 1)], "dataset_a_id int, dataset_b_id int, dataset_a_title string, dataset_b_title string, jaccard_score double, shared_columns array<string>, same_category boolean, needs_llm_label boolean, n_pairs bigint")
    prompt = evaluation.label_sample(pairs, 5).first().prompt
    assert '"T1"' in prompt and '"T2"' in prompt and "Columns in both: a" in prompt
    labels = spark.createDataFrame([(1, 2, True, True, "r", 0.9)], "dataset_a_id int, dataset_b_id int, similar boolean, joinable boolean, reasoning string, jaccard_score double")
    out = evaluation.attach_labels(pairs, labels, ["dataset_a_id", "dataset_b_id"], "judge")
    row = out.first()
    assert "needs_llm_label" not in out.columns and row.jaccard_score == 0.9 and row.label_source == "judge"
    assert tuple(evaluation.label_counts(out).first()) == (1, 1, 1, 1)
    similar = spark.createDataFrame([(1, 2), (1, 3)], "target_id int, dataset_id int")
    assert tuple(evaluation.evaluate_joinable(similar, out).first()) == (1, 1, 1.0)


def test_plans_stay_in_the_jvm(spark):
    from shelfmark.adapters import pages, titles

    for df in (pages(spark, "/root/testdata/sf0.001"), titles(spark, "/root/testdata/sf0.001")):
        plan = plan_of(df)
        assert "Python" not in plan and "ArrowEval" not in plan
    narrow = plan_of(titles(spark, "/root/testdata/sf0.001").select("id"))
    assert "p_retailprice" not in narrow.split("ReadSchema")[-1]


def test_profile_lines(spark):
    row = spark.createDataFrame([(["a", "b_kh"], "T ក", "", ["x", ""])], "c array<string>, t string, o string, k array<string>")
    got = row.select(records.profile(F.col("c"), F.col("t"), F.col("o"), F.col("k"))).first()[0]
    assert got == "Schema: a\nDataset: T\nCategories: x"


def test_options_are_values():
    assert sim.Options() == sim.Options(k=5)
