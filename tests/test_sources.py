import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators import catalog
from shelfmark.plans import records
from shelfmark.sources import envelopes, files

NOW = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone(timedelta(hours=7)))

CATALOG = [
    {
        "id": "a", "name": "Rice Exports (2008-2023)", "format": "CSV", "frequency": "Annual",
        "coverage_start": "2008", "coverage_end": "2023", "views_count": 5, "download_count": 2,
        "file_size": "10", "created_at": "2024-01-01", "description": 'says "hi", twice\nand more',
        "organization": {"organization_id": 1, "name_en": "Ministry of Farms", "abbreviation": "MF"},
        "categories": [
            {"category_id": 1, "name_en": "Trade", "slug": "trade"},
            {"category_id": 2, "name_en": "", "name_kh": "កសិកម្ម", "slug": "farm"},
        ],
    },
    {"id": "b", "name": "ថវិកា", "format": None, "organization": None, "categories": None},
    {"name": "no id"},
    {"id": "", "name": "empty id"},
    {"id": "c", "name": "Budget Law 2024", "format": "csv", "organization": {"name_kh": "ក", "abbreviation": "K"}, "categories": []},
]


def catalog_df(spark, tmp_path):
    path = tmp_path / "metadata.json"
    path.write_text(json.dumps(CATALOG, ensure_ascii=False), encoding="utf-8")
    return files.read_catalog(spark, str(path))


def columns_df(spark, tmp_path):
    rows = [
        {"id": "a", "columns": [{"title": "old"}]},
        {"id": "c", "columns": None, "error": "timeout"},
        {"id": "a", "columns": [{"title": "ref_year", "description": "the year"}, {"title": "name_kh"}, {"title": ""}, {"title": "Province EN"}]},
        {"columns": [{"title": "lost"}]},
    ]
    path = tmp_path / "column_metadata.json"
    path.write_text(json.dumps(rows), encoding="utf-8")
    return files.read_columns(spark, str(path))


def test_read_catalog_drops_records_without_id(spark, tmp_path):
    assert sorted(r.id for r in catalog_df(spark, tmp_path).collect()) == ["a", "b", "c"]


def test_json_lines(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text("\n".join(json.dumps(r) for r in CATALOG), encoding="utf-8")
    assert files.read_catalog(spark, str(path), whole_file=False).count() == 3


def test_missing_columns_file_is_empty(spark, tmp_path):
    df = files.read_columns(spark, str(tmp_path / "none.json"))
    assert df.count() == 0 and "columns" in df.columns


def test_records(spark, tmp_path):
    got = {r.id: r for r in records.build_records(catalog_df(spark, tmp_path), columns_df(spark, tmp_path)).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert a.series_key == "rice exports" and b.series_key == "" and c.series_key == "budget law"
    assert a.raw_columns == ["ref_year", "name_kh", "Province EN"]
    assert sorted(a.columns) == ["name", "province", "year"]
    assert a.category_slugs == ["trade", "farm"] and b.category_slugs == []
    assert a.covered and not b.covered
    assert a.organization_name == "Ministry of Farms" and b.organization_id is None
    assert a.profile == (
        "Schema: ref_year, Province EN\nDataset: Rice Exports (2008-2023)\n"
        "Organization: Ministry of Farms\nCategories: Trade"
    )
    assert b.profile == "" and c.profile == "Dataset: Budget Law 2024\nOrganization: K"


def test_first_category_records(spark, tmp_path):
    got = {r.id: r for r in records.first_category_records(catalog_df(spark, tmp_path)).collect()}
    assert got["a"].category_slug == "trade" and got["b"].category_slug is None


def test_schema_columns_and_unique_columns(spark, tmp_path):
    cols = columns_df(spark, tmp_path)
    got = records.schema_columns(catalog_df(spark, tmp_path), cols).collect()
    assert [(r.id, sorted(r.columns)) for r in got] == [("a", ["province", "year"])]
    titles = records.unique_columns(records.column_entries(cols), "ord")
    assert {(r.title, r.semantic_string) for r in titles.collect()} == {
        ("old", "old"), ("ref_year", "ref_year: the year"), ("Province EN", "Province EN"), ("lost", "lost"),
    }


def test_flatten_and_export(spark, tmp_path):
    out = str(tmp_path / "export")
    df = catalog_df(spark, tmp_path)
    files.export_csv(df, out, NOW, "https://example.org/datasets", api_total=3)
    flat = files.flatten_catalog(df)
    back = files.read_export(spark, out, ", ".join(f"{n} string" for n in flat.columns))
    rows = {r.id: r for r in back.collect()}
    assert rows["a"].categories == "Trade | កសិកម្ម" and rows["a"].description == CATALOG[0]["description"]
    assert rows["c"].organization == "ក" and len(flat.columns) == 16
    manifest = spark.read.json(out + "_manifest").first()
    assert (manifest.fetched_at, manifest.pulled, manifest.api_total) == ("2024-05-06T00:08:09Z", 3, 3)


def test_export_with_preamble(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("# fetched_at : now\n# pulled : 1\nid,name\n1,rice\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_export(spark, str(path), "id string, name string").collect()] == [("1", "rice")]


def test_snapshots_replace_their_day_only(spark, tmp_path):
    out = str(tmp_path / "snap")
    one = spark.createDataFrame([(1, "x")], "id int, v string")
    files.write_snapshot(one, out, NOW)
    files.write_snapshot(one.union(one), out, NOW + timedelta(days=1))
    files.write_snapshot(spark.createDataFrame([(2, "y")], "id int, v string"), out, NOW)
    got = sorted((str(r.snapshot_date), r.id, r.fetched_at) for r in spark.read.parquet(out).collect())
    assert got == [
        ("20240506", 2, "2024-05-06T00:08:09Z"),
        ("20240507", 1, "2024-05-07T00:08:09Z"),
        ("20240507", 1, "2024-05-07T00:08:09Z"),
    ]


def raw(spark, *bodies):
    return spark.createDataFrame([(i, b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)], "i int, raw string")


def test_envelope_shapes(spark):
    item = {"id": "ds-1", "title_en": "Budget 2024"}
    df = envelopes.unwrap_envelope(
        raw(
            spark,
            {"data": {"results": [item], "total": 1, "page": 1, "page_size": 20}},
            {"data": [item, item], "total_items": 9, "page": 2},
            {"results": [item], "total": 5, "total_pages": 5},
            [item, item, item],
            {"data": {"results": [], "total": 0}},
            {"data": None},
            "not json",
        )
    )
    rows = {}
    for r in df.collect():
        rows.setdefault(r.i, []).append(r)
    facts = {i: (len(r), r[0].n_records, r[0].total, r[0].page, r[0].page_size, r[0].total_pages) for i, r in rows.items()}
    assert facts == {
        0: (1, 1, 1, 1, 20, None), 1: (2, 2, 9, 2, None, None), 2: (1, 1, 5, None, None, 5), 3: (3, 3, 3, 1, 3, 1),
        4: (1, 0, 0, None, None, None), 5: (1, 0, None, None, None, None), 6: (1, 0, None, None, None, None),
    }
    typed = envelopes.typed_records(df.where("i = 0"))
    assert typed.first().title_en == "Budget 2024"
    assert envelopes.check_completeness(df.where("i = 1")).first() == (9, 2, False)
    assert envelopes.check_completeness(df.where("i = 3")).first() == (3, 3, True)
    assert envelopes.check_completeness(df.where("i = 5")).first() == (None, 0, None)


def page(n, ids, **more):
    return {"data": {"results": [{"id": i} for i in ids], "page": n, **more}}


def ids_of(df):
    return [r.x for r in df.select("ord", F.try_variant_get("record", "$.id", "int").alias("x")).orderBy("ord").collect()]


def test_assemble_pages(spark):
    def run(*bodies, **options):
        return ids_of(envelopes.assemble_pages(envelopes.unwrap_envelope(raw(spark, *bodies)), **options))

    pages = [page(2, [3, 4], total=5, page_size=2), page(1, [1, 2], total=5, page_size=2), page(3, [5], total=5, page_size=2)]
    assert run(*pages) == [1, 2, 3, 4, 5]
    assert run(*pages, cap=3) == [1, 2, 3]
    # Page 2 says it is the last one.
    assert run(page(1, [1], total_pages=2), page(2, [2], total_pages=2), page(3, [3], total_pages=2)) == [1, 2]
    # An empty page ends the harvest.
    more = {"total_pages": 9}
    assert run(page(1, [1], **more), page(2, [], **more), page(3, [3], **more)) == [1]
    # The cap also holds when one page has everything.
    assert run(page(1, [1, 2, 3], total=3), cap=2) == [1, 2]
    # Without a total one page is all there is.
    assert run(page(1, [1, 2])) == [1, 2]


def test_pages_without_number_and_landed_twice(spark):
    def run(*bodies):
        return ids_of(envelopes.assemble_pages(envelopes.unwrap_envelope(raw(spark, *bodies))))

    bare = [{"data": [{"id": i}], "total_items": 3, "page_size": 1} for i in (1, 2, 3)]
    assert run(*bare) == [1, 2, 3]
    # The later landing of a page counts, once.
    assert run(page(1, [1], total_pages=2), page(2, [8, 9], total_pages=2), page(2, [2], total_pages=2)) == [1, 2]


def test_last_wins_across_files(spark, tmp_path):
    """The later name wins, however Spark packs the files."""
    for name, words in (("a", "old"), ("b", "new")):
        rows = [{"id": "x", "columns": [{"title": words}]}]
        if name == "b":
            rows += [{"id": f"f{i}", "columns": [{"title": "filler " * 50}]} for i in range(200)]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    cols = files.read_columns(spark, str(tmp_path))
    (got,) = records.last_columns(cols).where("id = 'x'").collect()
    assert got.columns[0].title == "new"
    entries = records.column_entries(cols)
    first = entries.orderBy("ord").first()
    assert first.title == "old"


def test_readings_of_nested_types(spark):
    df = raw(spark, {"data": [{"price": 1.25, "tags": {"a": "b"}}]})
    (row,) = envelopes.unwrap_readings(df, "price decimal(10,2), tags map<string,string>").collect()
    assert str(row.price) == "1.25" and row.tags == {"a": "b"}


def test_readings_one_or_many(spark):
    rate = {"id": 1, "valid_date": "2024-01-01", "created_at": "2024-01-01T08:00:00", "currency_id": "USD", "data": {"buy": 4050.0}}
    df = raw(spark, {"data": rate}, {"data": [rate, {**rate, "id": 2, "data": None}]}, {"data": []})
    rows = envelopes.unwrap_readings(df, schemas.EXCHANGE_RATE).collect()
    assert [r.id for r in rows] == [1, 1, 2]
    assert json.loads(rows[0].data) == {"buy": 4050.0} and str(rows[0].valid_date) == "2024-01-01"


def test_index_and_stock_shapes(spark):
    full = {"id": 1, "created_at": "2024-01-01T00:00:00", "trading_volume": "1,200,000", "value": 400.5}
    rows = envelopes.unwrap_readings(raw(spark, {"data": full}, {"data": {"id": 2, "created_at": "2024-01-01T00:00:00"}}), schemas.INDEX_SNAPSHOT).collect()
    assert (rows[0].trading_volume, rows[1].value) == ("1,200,000", None)
    stock = {"id": 1, "name": "ABC", "created_at": "2024-01-01T00:00:00", "pe": "12.5"}
    assert envelopes.unwrap_readings(raw(spark, {"data": [stock]}), schemas.STOCK_SUMMARY).first().pe == "12.5"


def test_payload_or_body(spark):
    df = envelopes.payload_or_body(raw(spark, {"data": {"datasets": 3}}, {"datasets": 4}, {}), "datasets bigint, dataset_count bigint")
    got = catalog.reported_datasets(df.select("i", "payload.*")).orderBy("i").collect()
    assert [r.n_datasets for r in got] == [3, 4, 0]


def test_preview_rows(spark):
    body = {"data": {"results": [{"year": 2024, "value": 100}, {"year": 2023}], "total": 2}, "columns": ["year", {"name": "value"}, {"title": "t"}]}
    rows = envelopes.preview_rows(raw(spark, body)).orderBy("pos").collect()
    assert rows[0].row == {"year": "2024", "value": "100"} and rows[0].columns == ["year", "value", "t"]
    assert rows[1].row == {"year": "2023"} and rows[1].total == 2


def test_geo_features(spark):
    point = {"type": "Feature", "geometry": {"type": "Point", "coordinates": [104.9, 11.5]}, "properties": {"n": 1}}
    poly = {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [0, 0]]]}, "properties": None}
    rows = envelopes.geo_features(
        raw(spark, {"type": "FeatureCollection", "features": [point, poly]}, {"type": "FeatureCollection", "features": []})
    ).orderBy("i", "pos").collect()
    assert [r.geometry_type for r in rows] == ["Point", "Polygon", None]
    assert json.loads(rows[1].coordinates) == [[[0, 0], [1, 0], [0, 0]]]


def test_data_index_and_files(spark, tmp_path):
    cat = catalog_df(spark, tmp_path)
    info = spark.createDataFrame(
        [("a", [("1", "x.csv", "CSV", "u", "204800"), ("2", "x.xlsx", "XLSX", "v", "380 kB")]), ("c", [])],
        f"id string, files array<{schemas.FILE}>",
    )
    previews = spark.createDataFrame([("a", 9), ("c", 1250)], "id string, json_row_count bigint")
    index = envelopes.data_index(cat, info, previews)
    got = {r.id: (r.method, len(r.files), r.json_row_count) for r in index.collect()}
    assert got == {"a": ("file", 2, None), "b": ("none", 0, None), "c": ("json", 0, 1250)}
    entries = envelopes.file_entries(index)
    assert {(r.dataset_id, r.name, r.size_bytes) for r in entries.collect()} == {
        ("a", "x.csv", 204800), ("a", "x.xlsx", None), ("b", None, None), ("c", None, None),
    }
    summary = catalog.harvest_summary(index, F.size("files")).first()
    assert tuple(summary) == (3, 1, 1, 1, 2, 1250)
    assert [r.id for r in catalog.large_previews(index, 1000).collect()] == ["c"]


def test_vector_payload_keeps_empty_names(spark, tmp_path):
    got = {r.id: r.payload for r in files.vector_payload(catalog_df(spark, tmp_path)).collect()}
    assert got["a"].category == "Trade, " and got["a"].org == "Ministry of Farms"
    assert got["b"].name == "" and got["b"].frequency == ""
