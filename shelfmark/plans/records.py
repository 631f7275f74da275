"""Search records: a catalogue entry with its columns, keys and profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.text import (
    is_local_column,
    join_names,
    normalize_column,
    normalize_title,
    semantic_string,
    strip_script,
)
from shelfmark.functions.scores import is_covered
from shelfmark.functions.values import first_truthy, truthy, uuid5
from shelfmark.operators.rank import landing_order, last_wins


def last_columns(columns: DataFrame, order: str | None = None) -> DataFrame:
    """One definition row per dataset, the later one where a dataset is repeated.

    Without an ``order`` column the names of the files decide, then the place in the file.
    """
    known = columns.where(truthy("id").isNotNull())
    if order:
        return last_wins(known, ["id"], order)
    landed = known.withColumn("_ord", landing_order(columns))
    return last_wins(landed, ["id"], "_ord").drop("_ord")


def column_titles(columns: str | Column = "columns") -> Column:
    """Titles of a column list, empty ones left out; NULL list becomes empty."""
    c = F.col(columns) if isinstance(columns, str) else columns
    titles = F.filter(F.transform(c, lambda x: truthy(x["title"])), lambda t: t.isNotNull())
    return F.coalesce(titles, F.array().cast("array<string>"))


def profile(titles: Column, name: Column, organization: Column, categories: Column) -> Column:
    """Up to four lines: schema, dataset, organisation, categories. Empty parts are left out."""

    def line(label: str, text: Column) -> Column:
        return F.when(text != "", F.concat(F.lit(f"{label}: "), text))

    schema = F.array_join(F.filter(titles, lambda t: ~is_local_column(t)), ", ")
    return F.concat_ws(
        "\n",
        line("Schema", schema),
        line("Dataset", strip_script(name)),
        line("Organization", strip_script(organization)),
        line("Categories", join_names(categories)),
    )


def with_columns(catalog: DataFrame, columns: DataFrame, order: str | None = None) -> DataFrame:
    """Catalogue left joined with its column definitions."""
    return catalog.join(last_columns(columns, order).select("id", "columns"), "id", "left")


def build_records(catalog: DataFrame, columns: DataFrame, order: str | None = None) -> DataFrame:
    """One search record per catalogue entry with an id."""
    no_categories = F.array().cast(f"array<{schemas.CATEGORY}>")
    categories = F.coalesce("categories", no_categories)
    org_name = first_truthy("organization.name_en", "organization.abbreviation")
    slugs = F.array_compact(F.transform(categories, lambda c: truthy(c["slug"])))
    names = F.array_compact(F.transform(categories, lambda c: c["name_en"]))
    title = F.coalesce("name", F.lit(""))
    return (
        with_columns(catalog.where(truthy("id").isNotNull()), columns, order)
        .withColumn("raw_columns", column_titles())
        .select(
            "id",
            title.alias("title"),
            normalize_title(title).alias("series_key"),
            F.col("organization.organization_id").alias("organization_id"),
            org_name.alias("organization_name"),
            slugs.alias("category_slugs"),
            "frequency",
            "coverage_start",
            "coverage_end",
            is_covered("coverage_start", "coverage_end").alias("covered"),
            "raw_columns",
            F.array_distinct(F.transform("raw_columns", lambda c: normalize_column(c))).alias("columns"),
            profile(F.col("raw_columns"), title, F.coalesce(org_name, F.lit("")), names).alias("profile"),
        )
    )


def first_category_records(catalog: DataFrame) -> DataFrame:
    """The short record of a neighbour listing: title, organisation, first category."""
    return catalog.where(truthy("id").isNotNull()).select(
        "id",
        F.coalesce(first_truthy("name", "title_en"), F.lit("")).alias("title"),
        F.coalesce("organization.organization_id", "organization_id").alias("organization_id"),
        first_truthy("organization.name_en", "organization.abbreviation").alias("organization_name"),
        F.get(F.col("categories"), F.lit(0))["slug"].alias("category_slug"),
        "frequency",
        "coverage_start",
        "coverage_end",
    )


def schema_columns(catalog: DataFrame, columns: DataFrame) -> DataFrame:
    """Normalised column sets of known datasets, local-script columns left out."""
    titles = F.filter(column_titles(), lambda t: ~is_local_column(t))
    known = last_columns(columns).join(catalog.select("id"), "id", "left_semi")
    return known.select(
        "id", F.array_distinct(F.transform(titles, lambda t: normalize_column(t))).alias("columns")
    ).where(F.size("columns") > 0)


def unique_columns(entries: DataFrame, order: str) -> DataFrame:
    """Distinct titles with their last description and first position.

    ``entries`` holds title, description and an order column, one row per column of a
    dataset. Adds the text to embed and a name-based id.
    """
    kept = entries.where(truthy("title").isNotNull() & ~is_local_column("title"))
    return (
        kept.groupBy("title")
        .agg(
            F.max_by(F.struct("description"), F.col(order))["description"].alias("description"),
            F.min(order).alias("first_seen"),
        )
        .withColumn("semantic_string", semantic_string("title", "description"))
        .withColumn("id", uuid5("title"))
    )


def column_entries(columns: DataFrame) -> DataFrame:
    """title, description, ord for every column of every dataset, in file order."""
    return (
        columns.withColumn("_row", landing_order(columns))
        .select("_row", F.posexplode("columns").alias("_pos", "c"))
        .select(
            F.struct("_row", "_pos").alias("ord"),
            F.col("c.title").alias("title"),
            F.col("c.description").alias("description"),
        )
    )
