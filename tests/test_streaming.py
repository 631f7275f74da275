import json
import os

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.operators.readings import latest_per_key
from shelfmark.operators.upsert import BUCKET, read_table, rows_beside, upsert_table
from shelfmark.streaming import jobs


def land(folder, name, body):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(body), encoding="utf-8")


def reading(i, name, time):
    return {"id": i, "name": name, "created_at": time, "last_updated": time, "data": {"temp_c": i}}


@pytest.mark.parametrize("delay", [None, "400 days"])
def test_stream_equals_batch_and_late_rows_do_not_win(spark, tmp_path, delay):
    """Three starts of the stream: state and progress outlive a restart."""
    folder, path = tmp_path / "in", str(tmp_path / "table")

    def run():
        feed = jobs.stream_readings(jobs.landed_bodies(spark, str(folder), 1), schemas.PROVINCE_READING)
        jobs.stream_latest(feed, path, ["name"], "last_updated", delay=delay, buckets=3).start().awaitTermination()
        return {r.name: r.id for r in read_table(spark, path).collect()}

    land(folder, "1.json", {"data": [reading(1, "Kep", "2024-01-02T00:00:00"), reading(2, "Takeo", "2024-01-02T00:00:00")]})
    land(folder, "2.json", {"data": reading(3, "Kep", "2024-01-03T00:00:00")})
    assert run() == {"Kep": 3, "Takeo": 2}
    # Late, repeated, and a province that had been silent.
    land(folder, "3.json", {"data": [reading(4, "Kep", "2024-01-01T00:00:00"), reading(2, "Takeo", "2024-01-02T00:00:00"), reading(5, "Pailin", "2023-01-01T00:00:00")]})
    assert run() == {"Kep": 3, "Takeo": 2, "Pailin": 5}
    bodies = spark.read.option("wholetext", True).text(str(folder)).withColumnRenamed("value", "raw")
    batch = latest_per_key(jobs.stream_readings(bodies, schemas.PROVINCE_READING), ["name"], "last_updated")
    assert {r.name: r.id for r in batch.collect()} == run()


def test_watermark_drops_what_is_too_late(spark, tmp_path):
    folder, path = tmp_path / "in", str(tmp_path / "table")

    def run():
        feed = jobs.stream_readings(jobs.landed_bodies(spark, str(folder), 1), schemas.PROVINCE_READING)
        jobs.stream_latest(feed, path, ["name"], "last_updated", delay="1 day", buckets=2).start().awaitTermination()
        return {r.name: r.id for r in read_table(spark, path).collect()}

    land(folder, "1.json", {"data": [reading(1, "Kep", "2024-01-10T00:00:00")] * 3})
    assert run() == {"Kep": 1}
    land(folder, "2.json", {"data": reading(2, "Kep", "2024-01-20T00:00:00")})
    assert run() == {"Kep": 2}
    # ten days behind the newest reading: no state is kept for it any more
    land(folder, "3.json", {"data": [reading(3, "Takeo", "2024-01-09T00:00:00"), reading(4, "Pailin", "2024-01-19T12:00:00")]})
    assert run() == {"Kep": 2, "Pailin": 4}


def test_incremental_catalog(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "id string, name string, updated_at timestamp"

    def run(*rows):
        spark.createDataFrame(rows, "id string, name string, t string").select(
            "id", "name", F.col("t").cast("timestamp").alias("updated_at")
        ).coalesce(1).write.mode("append").parquet(folder)
        records = spark.readStream.schema(schema).parquet(folder)
        jobs.stream_incremental_catalog(records, path, buckets=2).start().awaitTermination()
        return {r.id: r.name for r in read_table(spark, path).collect()}

    assert run(("a", "one", "2024-01-01"), ("b", "two", "2024-01-01")) == {"a": "one", "b": "two"}
    assert run(("a", "older", "2023-01-01"), ("b", "newer", "2024-02-01"), ("c", "undated", None)) == {"a": "one", "b": "newer"}


def test_embed_pending_embeds_once(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "table")
    calls = spark.sparkContext.accumulator(0)

    def fn(texts):
        calls.add(len(texts))
        if "fails" in texts:
            raise RuntimeError("no")
        return [[float(len(t))] for t in texts]

    payload = schemas.VECTOR_PAYLOAD
    schema = f"id string, profile string, payload {payload}"

    def run(*rows):
        spark.createDataFrame(rows, "id string, profile string").withColumn(
            "payload", F.lit(None).cast(payload)
        ).coalesce(1).write.mode("append").parquet(folder)
        profiles = spark.readStream.schema(schema).parquet(folder)
        jobs.stream_embed_pending(profiles, path, fn, buckets=2).start().awaitTermination()
        return {r.id: r.vector for r in read_table(spark, path).collect()}

    assert run(("a", "x"), ("b", "yy")) == {"a": [1.0], "b": [2.0]}
    assert run(("a", "x"), ("b", "zzz")) == {"a": [1.0], "b": [3.0]}
    assert calls.value == 3
    assert run(("c", "fails"))["c"] is None
    before = calls.value
    assert run(("c", "fails"), ("a", "x"))["c"] is None
    assert calls.value > before


# ── keyed tables ────────────────────────────────────────────────────────────────


def files_of(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    path = str(tmp_path / "table")
    assert read_table(spark, path) is None
    rows = spark.range(1000).select("id", (F.col("id") * 2).alias("v"))
    upsert_table(spark, path, rows, buckets=16)
    before = files_of(path)
    new = spark.createDataFrame([(7, -1), (5000, -2), (None, -3)], "id long, v long")
    # the table keeps its own number of buckets
    upsert_table(spark, path, new, buckets=3)
    after = files_of(path)
    gone = {os.path.dirname(p) for p in before if p not in after}
    touched = {f"{BUCKET}={r[0]}" for r in rows_beside(spark, path, new.dropna()).select(BUCKET).distinct().collect()}
    assert 1 <= len(gone) <= 2 and {os.path.basename(p) for p in gone} <= touched
    kept = [p for p in before if p in after]
    assert len(kept) >= 14 and all(before[p] == after[p] for p in kept)
    got = {r.id: r.v for r in read_table(spark, path).collect()}
    assert got == {**{i: 2 * i for i in range(1000)}, 7: -1, 5000: -2}


def test_upsert_run_again_gives_the_same_table(spark, tmp_path):
    path = str(tmp_path / "table")
    first = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "k string, j int, v int")
    second = spark.createDataFrame([("a", 1, 7, "new"), ("c", 2, 8, "new")], "k string, j int, v int, w string")
    upsert_table(spark, path, first, ["k", "j"], 4)
    for _ in range(3):
        upsert_table(spark, path, second, ["k", "j"], 4)
    rows = spark.read.option("mergeSchema", True).parquet(path)
    assert {(r.k, r.j): (r.v, r.w) for r in rows.collect()} == {
        ("a", 1): (7, "new"), ("b", 1): (6, None), ("c", 2): (8, "new"),
    }
    upsert_table(spark, path, second.limit(0), ["k", "j"], 4)
    assert read_table(spark, path).count() == 3


def test_landed_files_grow_in_number_and_not_in_size(spark, monkeypatch):
    from shelfmark import queries

    d, path = "/root/testdata/sf0.001", []
    monkeypatch.setattr(queries, "LANDED_ROWS", 50)
    made = queries._folder
    monkeypatch.setattr(queries, "_folder", lambda s, name: path.append(made(s, name)) or path[-1])
    assert queries.stream_embed(spark, d).count() == spark.read.parquet(f"{d}/documents.parquet").count()
    files = spark.read.parquet(path[0]).groupBy("_metadata.file_path").count().collect()
    assert len(files) >= 6 and max(r["count"] for r in files) <= 100
