"""The shared test tables seen as a catalogue.

Each adapter is plain column work, so that the same view can be written in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.text import normalize_column, normalize_title

BLANK = "[ \t\r\n]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a few files over all cores, where parsing them costs more than moving them.

    A file of one row group is read by one task, however many cores there are. Tables of
    more files than cores are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as datasets of yearly series: id, title, series_key and catalogue fields."""
    part = spread(table(spark, sf_dir, "part"))
    year = F.lit(2000) + F.col("p_size")
    style = F.pmod("p_partkey", F.lit(3))
    suffix = (
        F.when(style == 0, F.concat(F.lit(" FY"), year))
        .when(style == 1, F.concat(F.lit(" ("), year, F.lit("-"), year + 1, F.lit(")")))
        .otherwise(F.concat(F.lit(" "), year))
    )
    title = F.concat("p_name", F.lit(" "), "p_brand", suffix)
    return part.select(
        F.col("p_partkey").alias("id"),
        title.alias("title"),
        normalize_title(title).alias("series_key"),
        F.col("p_brand").alias("organization_id"),
        F.col("p_type").alias("category"),
        F.array("p_type").alias("category_slugs"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("price"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as schemas: the distinct words of the whole text are the columns."""
    w = F.split(F.lower("text"), BLANK)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return spread(docs).select(
        F.col("doc_id").alias("id"),
        F.col("lang").alias("category"),
        F.col("source").alias("organization_id"),
        F.array_remove(F.array_distinct(w), "").alias("columns"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as catalogue records; the names of all links on a page are its columns."""
    host = F.regexp_extract("url", "https?://([^/]+)/", 1)
    lang = F.regexp_extract("url", "https?://[^/]+/([a-z]+)/", 1)
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    links = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    names = F.array_distinct(F.transform(links, lambda x: normalize_column(x)))
    has_query = F.contains("url", F.lit("?"))
    return spread(table(spark, sf_dir, "pages")).select(
        F.col("page_id").alias("id"),
        title.alias("title"),
        normalize_title(title).alias("series_key"),
        host.alias("organization_id"),
        F.array_remove(F.array(lang), "").alias("category_slugs"),
        F.regexp_extract("url", "^([a-z]+)", 1).alias("frequency"),
        has_query.alias("covered"),
        F.array_remove(names, "").alias("columns"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings of a feed keyed by event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("name"), "ts", "user_id", "value", "props"
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as articles."""
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        "conv_id",
        F.col("role").alias("category"),
        F.col("text").alias("title_en"),
        F.col("turn").alias("created_at"),
    )
