"""Streams of landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shelfmark.operators.embed import EmbedFn, PROFILE_BATCH
from shelfmark.operators.rank import last_wins
from shelfmark.operators.upsert import BUCKETS, rows_beside, upsert_table
from shelfmark.plans.search import embedded_pending
from shelfmark.session import durable
from shelfmark.sources.envelopes import unwrap_readings

STORED_VECTORS = (
    "id string, vector array<float>, payload struct<dataset_id:string,name:string,"
    "category:string,org:string,frequency:string,coverage_start:string,coverage_end:string>, "
    "profile_hash string, error string"
)


def landed_bodies(spark: SparkSession, path: str, files_per_batch: int = 1_000) -> DataFrame:
    """Stream of landed response bodies, one file each, as a ``raw`` text column."""
    return (
        spark.readStream.format("text")
        .schema("value string")
        .option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .withColumnRenamed("value", "raw")
    )


def deduplicated(readings: DataFrame, id_col: str, time: str, delay: str) -> DataFrame:
    """Drop repeats of a reading that arrive within ``delay`` of each other."""
    return readings.withWatermark(time, delay).dropDuplicatesWithinWatermark([id_col])


def stream_readings(bodies: DataFrame, schema: str) -> DataFrame:
    return unwrap_readings(bodies, schema)


def newest_state(rows: DataFrame, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """The newest row of every key, kept by Spark as the state of a streaming aggregation.

    Rows without a time are older than all others; of equal times the larger ``tie`` wins.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(time), F.col(tie)))
    return rows.groupBy(*keys).agg(newest.alias("_newest")).select(*keys, "_newest.*")


def _to_table(rows: DataFrame, path: str, keys: Sequence[str], mode: str, buckets: int) -> DataStreamWriter:
    """Writer that puts the rows of each batch over those of the same key in a keyed table."""

    def sink(batch: DataFrame, _: int) -> None:
        upsert_table(batch.sparkSession, path, batch, keys, buckets)

    return (
        rows.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{path}/_progress")
        .outputMode(mode)
        .trigger(availableNow=True)
    )


def stream_latest(
    readings: DataFrame,
    path: str,
    keys: Sequence[str],
    time: str,
    id_col: str = "id",
    delay: str | None = None,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Keep the newest reading per key in the keyed table at ``path``; ``.start()`` the writer.

    The newest reading is the state of the query, one row per key in Spark's state store, so
    repeats and late readings change nothing they should not, and a late reading of a key
    that has been silent still counts. A batch emits the keys that changed, and only their
    buckets of the table are written. ``delay`` sets a watermark: repeats of an id within it
    are dropped before the aggregation, and so are readings older than the watermark.
    """
    source = readings if delay is None else deduplicated(readings, id_col, time, delay)
    return _to_table(newest_state(source, keys, time, id_col), path, keys, "update", buckets)


def stream_incremental_catalog(
    records: DataFrame,
    path: str,
    key: str = "id",
    updated: str = "updated_at",
    tie: str | None = None,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Apply catalogue records that are newer than what the table at ``path`` holds.

    Records without an update time or key are passed over; of equal times the larger ``tie``
    (by default the key, so any) wins.
    """
    known = records.where(F.col(updated).isNotNull() & F.col(key).isNotNull())
    return _to_table(newest_state(known, [key], updated, tie or key), path, [key], "update", buckets)


def stream_embed_pending(
    profiles: DataFrame,
    path: str,
    fn: EmbedFn,
    key: str = "profile",
    batch_size: int = PROFILE_BATCH,
    order: str = "profile",
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Embed new and changed profiles once; failed ones are tried again when they next arrive.

    ``profiles`` streams id, profile and payload; of several rows of one id in a batch the
    last by ``order`` is taken. The table at ``path`` holds the vectors; a batch reads and
    writes only the buckets of the ids it brings.
    """

    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        latest = durable(last_wins(batch, ["id"], order))
        stored = rows_beside(spark, path, latest)
        if stored is None:
            stored = spark.createDataFrame([], STORED_VECTORS)
        new = embedded_pending(latest, latest, stored, fn, key, batch_size)
        upsert_table(spark, path, new, buckets=buckets)

    return (
        profiles.writeStream.foreachBatch(sink)
        .option("checkpointLocation", f"{path}/_progress")
        .trigger(availableNow=True)
    )
