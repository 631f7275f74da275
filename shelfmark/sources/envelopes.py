"""Landed JSON bodies to rows.

Bodies are parsed once into a variant; paths that a body does not have give NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.functions.values import first_truthy
from shelfmark.operators.rank import landing_order, running_total


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _first(*cols: Column) -> Column:
    return F.coalesce(*cols)


def unwrap_envelope(raw: DataFrame, body: str = "raw") -> DataFrame:
    """One row per record of a list body, in any of its four shapes.

    ``{"data": {"results": [...], "total": n, ...}}``, ``{"data": [...], "total_items": n}``,
    ``{"results": [...], ...}`` and a bare list, whose length is its total. Adds record (a
    variant), pos, n_records, total, page, page_size, total_pages, and landed, the order in
    which the bodies landed; an empty body keeps one row with a NULL record.
    """
    v = F.try_parse_json(body)
    df = raw.withColumn("landed", landing_order(raw)).withColumn("_v", v)
    many = "array<variant>"
    bare = _get(F.col("_v"), "$", many)
    flat = _get(F.col("_v"), "$.data", many)
    nested = _get(F.col("_v"), "$.data.results", many)
    inner = _get(F.col("_v"), "$.results", many)
    df = df.withColumn("_bare", bare.isNotNull()).withColumn(
        "_records", _first(bare, flat, nested, inner)
    )
    size = F.size("_records").cast("bigint")

    def number(name: str) -> Column:
        return _first(
            _get(F.col("_v"), f"$.data.{name}", "bigint"), _get(F.col("_v"), f"$.{name}", "bigint")
        )

    total = _first(number("total"), _get(F.col("_v"), "$.total_items", "bigint"))
    return (
        df.withColumn("n_records", F.coalesce(F.when(size >= 0, size), F.lit(0)))
        .withColumn("total", F.when(F.col("_bare"), size).otherwise(total))
        .withColumn("page", F.when(F.col("_bare"), 1).otherwise(number("page")))
        .withColumn("page_size", F.when(F.col("_bare"), size).otherwise(number("page_size")))
        .withColumn("total_pages", F.when(F.col("_bare"), 1).otherwise(number("total_pages")))
        .select("*", F.posexplode_outer("_records").alias("pos", "record"))
        .drop("_v", "_bare", "_records")
    )


def payload_or_body(raw: DataFrame, schema: str, body: str = "raw") -> DataFrame:
    """Fields of ``data`` where the body has it, else of the body itself."""
    text = F.coalesce(F.get_json_object(body, "$.data"), F.col(body))
    return raw.withColumn("payload", F.from_json(text, schema))


def unwrap_readings(raw: DataFrame, schema: str, body: str = "raw") -> DataFrame:
    """Rows of a feed whose ``data`` is one object or a list of objects; ``schema`` is DDL."""
    row = T.StructType.fromDDL(schema.removeprefix("struct<").removesuffix(">") if schema.startswith("struct<") else schema)
    listed = F.from_json(F.get_json_object(body, "$.data"), T.ArrayType(row))
    return raw.select(F.explode(listed).alias("_r")).select("_r.*")


def assemble_pages(
    pages: DataFrame, default_size: int = 10_000, cap: int | None = None, landed: str = "landed"
) -> DataFrame:
    """Records of unwrapped pages in page order, up to the last page or an empty one.

    ``pages`` is the output of :func:`unwrap_envelope`, written or otherwise stable. A body
    without a page number is the page that its place in the landing order makes it. Of a
    page that landed more than once the last landing counts. The last page is the first one
    that reaches total_pages (else ceil(total / size), total falling back to the page's
    length). Positions come from the page sizes alone, so records are not sorted globally.
    """
    size = F.coalesce(F.nullif("page_size", F.lit(0)), F.lit(default_size))
    last = F.coalesce(
        F.nullif("total_pages", F.lit(0)),
        F.ceil(F.coalesce(F.nullif("total", F.lit(0)), F.col("n_records")) / size),
    )
    # One row per landed body, thousands of records each.
    bodies = pages.groupBy(F.col(landed).alias("landed")).agg(
        F.max("page").alias("given"), F.max("n_records").alias("n"), F.max(last).alias("last")
    )
    numbered = running_total(bodies, [F.col("landed")], F.lit(1).cast("bigint"), "earlier").withColumn(
        "page", F.coalesce("given", F.col("earlier") + 1)
    )
    per_page = (
        numbered.groupBy("page")
        .agg(F.max_by(F.struct("landed", "n", "last"), "landed").alias("b"))
        .select("page", "b.*")
    )
    stop = per_page.where((F.col("page") >= F.col("last")) | (F.col("n") == 0))
    stop_page = stop.agg(F.min("page")).scalar()
    kept = per_page.where(F.coalesce(F.col("page") <= stop_page, F.lit(True)) & (F.col("n") > 0))
    offsets = running_total(kept, [F.col("page")], F.col("n"), "start").select(
        F.col("landed").alias("_landed"), F.col("page").alias("_page"), "start"
    )
    records = (
        pages.where(F.col("record").isNotNull())
        .join(offsets, F.col(landed) == F.col("_landed"))
        .withColumn("ord", F.col("start") + F.col("pos"))
        .withColumn("page", F.col("_page"))
        .drop("start", "_landed", "_page")
    )
    return records if cap is None else records.where(F.col("ord") < cap)


def typed_records(records: DataFrame, schema: str = schemas.CATALOG) -> DataFrame:
    """Typed fields of each record; the raw variant stays beside them."""
    row = F.from_json(F.to_json("record"), schema)
    return records.withColumn("_r", row).select(
        *[c for c in records.columns if c != "record"], "_r.*", "record"
    )


def check_completeness(records: DataFrame, total: str = "total") -> DataFrame:
    """Pulled against reported count; ``count_matched`` is NULL when none was reported."""
    pulled, reported = F.count("record"), F.max(total)
    return records.agg(
        reported.alias("api_reported_total"),
        pulled.alias("pulled_count"),
        F.when(reported.isNotNull(), reported == pulled).alias("count_matched"),
    )


def preview_rows(raw: DataFrame, body: str = "raw") -> DataFrame:
    """One row per preview record: ``row`` maps column to text; ``columns`` lists names.

    The column list holds names or objects with a ``name`` (or ``title``).
    """
    v = F.try_parse_json(body)
    listed = F.transform(
        F.try_variant_get(v, "$.columns", "array<variant>"),
        lambda c: F.coalesce(
            F.try_variant_get(c, "$.name", "string"),
            F.try_variant_get(c, "$.title", "string"),
            F.try_variant_get(c, "$", "string"),
        ),
    )
    rows = F.from_json(F.get_json_object(body, "$.data.results"), "array<map<string,string>>")
    return (
        raw.withColumn("columns", listed)
        .withColumn("total", F.get_json_object(body, "$.data.total").try_cast("bigint"))
        .select("*", F.posexplode(rows).alias("pos", "row"))
        .drop(body)
    )


def preview_values(raw: DataFrame, body: str = "raw") -> DataFrame:
    """One row per preview record, kept as a variant: the columns of ``raw``, pos, row."""
    rows = F.try_variant_get(F.try_parse_json(body), "$.data.results", "array<variant>")
    return raw.select("*", F.posexplode(rows).alias("pos", "row")).drop(body)


def wide_preview(rows: DataFrame, row: str = "row") -> DataFrame:
    """Preview records as one typed table: a column per field that any of them has.

    Names and types are those that fit all records together (one pass, one aggregated schema);
    a record without a field has NULL there, and a field that clashes with a column of
    ``rows`` gets ``_field`` behind its name. Fields of mixed kinds stay variants. Records
    that are no objects have no fields.
    """
    objects = F.when(F.schema_of_variant(row).startswith("OBJECT"), F.col(row))
    schema = rows.select(F.schema_of_variant_agg(objects)).first()[0]
    taken = {c.lower() for c in rows.columns}
    fields = []
    for name, kind in variant_fields(schema or ""):
        shown = name
        while shown.lower() in taken:
            shown += "_field"
        taken.add(shown.lower())
        # a path can't name a field with both kinds of quotes
        quote = '"' if '"' not in name else "'"
        value, path = F.col(row), f"$[{quote}{name}{quote}]"
        if quote in name:
            value, path = F.try_variant_get(row, "$", "map<string,variant>")[name], "$"
        fields.append(F.try_variant_get(value, path, kind).alias(shown))
    return rows.select(*[c for c in rows.columns if c != row], *fields)


def variant_fields(schema: str) -> list[tuple[str, str]]:
    """(name, type) of the fields of an aggregated variant schema, as ``OBJECT<a: BIGINT, ...>``."""
    if not schema.startswith("OBJECT<"):
        return []
    kinds = schema.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    if kinds == "STRUCT<>":
        return []
    struct = T.StructType.fromDDL(f"r {kinds}")["r"].dataType
    return [(f.name, f.dataType.simpleString()) for f in struct]


def geo_features(raw: DataFrame, body: str = "raw") -> DataFrame:
    """One row per feature of a FeatureCollection.

    ``coordinates`` stays JSON text, its depth depends on the geometry; ``properties`` is a
    variant. A collection without features keeps one row.
    """
    v = F.try_parse_json(body)
    features = F.try_variant_get(v, "$.features", "array<variant>")
    f = F.col("_f")
    return (
        raw.withColumn("collection_type", F.get_json_object(body, "$.type"))
        .select("*", F.posexplode_outer(features).alias("pos", "_f"))
        .withColumn("geometry_type", F.try_variant_get(f, "$.geometry.type", "string"))
        .withColumn("coordinates", F.to_json(F.try_variant_get(f, "$.geometry.coordinates", "variant")))
        .withColumn("properties", F.try_variant_get(f, "$.properties", "variant"))
        .drop("_f", body)
    )


def file_entries(index: DataFrame) -> DataFrame:
    """One row per file of a dataset; a dataset without files keeps one row of NULLs."""
    return index.select("id", F.explode_outer("files").alias("_f")).select(
        F.col("id").alias("dataset_id"),
        F.col("_f.name").alias("name"),
        F.col("_f.format").alias("format"),
        F.col("_f.url").alias("url"),
        F.col("_f.size").alias("size"),
        F.col("_f.size").try_cast("bigint").alias("size_bytes"),
    )


def data_index(catalog: DataFrame, file_info: DataFrame, previews: DataFrame) -> DataFrame:
    """How each dataset can be reached: files, else a row preview, else nothing.

    ``file_info`` holds id and files, ``previews`` id and json_row_count (one row for every
    dataset whose preview answered).
    """
    has_files = F.coalesce(F.size("files") > 0, F.lit(False))
    answered = F.coalesce("_answered", F.lit(False))
    return (
        catalog.select(
            first_truthy("id", "slug", "uuid").alias("id"),
            first_truthy("title_en", "name").alias("title_en"),
            "title_kh",
            "categories",
            "organization",
        )
        .where(F.col("id").isNotNull())
        .join(file_info.select("id", "files"), "id", "left")
        .join(previews.select("id", "json_row_count", F.lit(True).alias("_answered")), "id", "left")
        .withColumn(
            "method", F.when(has_files, "file").when(answered, "json").otherwise("none")
        )
        .withColumn("json_row_count", F.when(F.col("method") == "json", F.col("json_row_count")))
        .withColumn(
            "files", F.coalesce("files", F.array().cast(f"array<{schemas.FILE}>"))
        )
        .drop("_answered")
    )
