"""Reading and writing catalogue files."""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.functions.text import join_names, strip_script
from shelfmark.functions.values import first_truthy, truthy

log = logging.getLogger(__name__)


def _read(spark: SparkSession, path: str, schema: str, fmt: str, whole_file: bool) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.option("multiLine", whole_file).json(path)
    return reader.format(fmt).load(path)


def read_catalog(
    spark: SparkSession, path: str, fmt: str = "json", whole_file: bool = True, extras: str | None = None
) -> DataFrame:
    """Catalogue records; those without an id are dropped.

    ``whole_file`` reads files that hold one JSON array each. Large landings come as JSON
    lines (``whole_file=False``) or parquet, which Spark can split. ``extras`` names a column
    that keeps each JSON record whole, as a variant beside the typed fields, so that fields
    outside the schema can be asked for later (:func:`extra_fields`).
    """
    if extras is None:
        records = _read(spark, path, schemas.CATALOG, fmt, whole_file)
    else:
        if fmt != "json":
            raise ValueError("extras are kept for JSON only")
        reader = spark.read.option("singleVariantColumn", extras).option("multiLine", whole_file)
        whole = reader.json(path)
        if whole_file:  # a file is one array, or a single record
            listed = F.try_variant_get(extras, "$", "array<variant>")
            whole = whole.select(F.explode(F.coalesce(listed, F.array(extras))).alias(extras))
        fields = [
            F.try_variant_get(extras, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
            for f in T.StructType.fromDDL(schemas.CATALOG)
        ]
        records = whole.select(*fields, extras)
    return records.where(truthy("id").isNotNull())


def extra_fields(records: DataFrame, extras: str, fields: str) -> DataFrame:
    """``records`` with ``fields`` (as in a schema, ``license string, tags array<string>``) read
    from the variant column that :func:`read_catalog` kept; absent or unfitting values are NULL."""
    wanted = T.StructType.fromDDL(fields)
    got = {f.name: F.try_variant_get(extras, f"$.{f.name}", f.dataType.simpleString()) for f in wanted}
    return records.withColumns(got)


def read_columns(
    spark: SparkSession, path: str, fmt: str = "json", whole_file: bool = True
) -> DataFrame:
    """Column definitions; a missing file is an empty table."""
    try:
        return _read(spark, path, schemas.COLUMN_METADATA, fmt, whole_file)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("%s not found, going on without column definitions", path)
        return spark.createDataFrame([], schemas.COLUMN_METADATA)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row and optional ``# key: value`` lines above it."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("comment", "#")
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def flatten_catalog(df: DataFrame) -> DataFrame:
    """The 16 flat columns of an export."""
    names = F.transform(
        F.coalesce("categories", F.array().cast(f"array<{schemas.CATEGORY}>")),
        lambda c: F.coalesce(first_truthy(c["name_en"], c["name_kh"]), F.lit("")),
    )
    return df.select(
        "id",
        "name",
        "format",
        "frequency",
        F.coalesce(
            first_truthy("organization.name_en", "organization.name_kh"), F.lit("")
        ).alias("organization"),
        F.coalesce(truthy("organization.abbreviation"), F.lit("")).alias("organization_abbr"),
        F.array_join(names, " | ").alias("categories"),
        F.col("views_count").alias("views"),
        F.col("download_count").alias("downloads"),
        F.col("file_size").alias("file_size_bytes"),
        "created_at",
        "updated_at",
        "coverage_start",
        "coverage_end",
        "file_url",
        "description",
    )


def _stamp(fetched_at: datetime):
    if fetched_at.tzinfo is None:
        fetched_at = fetched_at.replace(tzinfo=timezone.utc)
    utc = fetched_at.astimezone(timezone.utc)
    return F.lit(utc.strftime("%Y-%m-%dT%H:%M:%SZ")), F.lit(utc.strftime("%Y%m%d"))


def snapshot(df: DataFrame, fetched_at: datetime) -> DataFrame:
    """Rows stamped with the run's UTC time and date; the run time is handed in."""
    time, date = _stamp(fetched_at)
    return df.withColumn("fetched_at", time).withColumn("snapshot_date", date)


def write_snapshot(df: DataFrame, path: str, fetched_at: datetime, fmt: str = "parquet") -> None:
    """One dated folder per run below ``path``; running a day again replaces that day only."""
    (
        snapshot(df, fetched_at)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .format(fmt)
        .save(path)
    )


def write_manifest(
    df: DataFrame, path: str, fetched_at: datetime, source: str, api_total: int | None = None
) -> None:
    """The facts a file export states above its header, as one JSON row next to it."""
    time, _ = _stamp(fetched_at)
    df.agg(
        time.alias("fetched_at"),
        F.lit(api_total).cast("bigint").alias("api_total"),
        F.count(F.lit(1)).alias("pulled"),
        F.lit(source).alias("source"),
    ).write.mode("overwrite").json(path)


def export_csv(
    df: DataFrame,
    path: str,
    fetched_at: datetime,
    source: str,
    api_total: int | None = None,
) -> None:
    """Flat catalogue as CSV with a header, and its manifest in ``<path>_manifest``."""
    flat = flatten_catalog(df)
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    write_manifest(flat, path + "_manifest", fetched_at, source, api_total)


def vector_payload(catalog: DataFrame) -> DataFrame:
    """What is stored beside each dataset vector."""
    name = F.coalesce(
        first_truthy("organization.name_en", "organization.abbreviation"), F.lit("")
    )
    categories = F.transform(
        F.coalesce("categories", F.array().cast(f"array<{schemas.CATEGORY}>")),
        lambda c: F.coalesce(c["name_en"], F.lit("")),
    )
    return catalog.select(
        F.col("id"),
        F.struct(
            F.col("id").alias("dataset_id"),
            strip_script("name").alias("name"),
            join_names(categories, keep_empty=True).alias("category"),
            strip_script(name).alias("org"),
            F.coalesce("frequency", F.lit("")).alias("frequency"),
            F.coalesce("coverage_start", F.lit("")).alias("coverage_start"),
            F.coalesce("coverage_end", F.lit("")).alias("coverage_end"),
        ).alias("payload"),
    )
