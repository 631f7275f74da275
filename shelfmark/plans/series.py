"""Series of datasets: titles that differ only in their year."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.values import truthy
from shelfmark.operators.groups import attach_counts
from shelfmark.session import durable

# Ids in the lists that one task writes.
LIST_IDS = 2_000_000
MAX_PARTS = 10_000


def series_members(df: DataFrame, id_col: str = "id", title: str = "title", key: str = "series_key") -> DataFrame:
    """Members of every series with more than one: series_key, id, title, n_members.

    This table is the ground truth of "temporal variant": two members of one series that
    are not the same dataset. It grows with the datasets, not with their pairs.
    """
    named = df.where(truthy(key).isNotNull() & truthy(title).isNotNull()).select(
        F.col(key).alias("series_key"), F.col(id_col).alias("id"), F.col(title).alias("title")
    )
    return attach_counts(durable(named), ["series_key"], count="n_members").where(F.col("n_members") > 1)


def series_pairs(members: DataFrame, joined: str | None = None) -> DataFrame:
    """One evaluation case per member of a series, with the sorted ids of all others.

    The lists are as long as the result asks for: k members have k lists of k - 1 ids. Where
    that is too much, :func:`series_members` is the same truth in linear size, and hit tests
    join on it. The members are dealt by the ids they are to list, however small their own
    table is. With ``joined`` a list is one text, with that between the ids: a series writes
    it once, and a member cuts itself out of it by its place. ``members`` is read twice.
    """
    key = "series_key"
    ids = members.groupBy(key).agg(
        F.sort_array(F.collect_list("id")).alias("_all"), F.ceil(F.count(F.lit(1)) * F.count(F.lit(1)) / LIST_IDS).alias("_n")
    )
    listed = members.agg(F.coalesce(F.sum("n_members"), F.lit(0))).first()[0]
    parts = min(listed // LIST_IDS + 1, MAX_PARTS)
    if joined is None:
        others = F.filter("_all", lambda x: x != F.col("id"))
    else:
        texts = F.array_join(F.col("_all").cast("array<string>"), joined)
        ids = ids.withColumn("_all", texts.cast("binary"))
        # Where the member's own id begins in the text, and how far it goes with what follows it.
        wide = F.octet_length(F.col("id").cast("string")) + F.octet_length(F.lit(joined))
        own = wide * F.count(F.lit(1)).over(Window.partitionBy(key, "id"))
        members = members.withColumn("_end", F.sum(wide).over(Window.partitionBy(key).orderBy("id")).cast("int"))
        members = members.withColumn("_start", (F.col("_end") - own).cast("int"))
        whole = F.octet_length("_all")
        last = F.col("_end") > whole
        kept = F.when(last, F.greatest(F.col("_start") - F.octet_length(F.lit(joined)), F.lit(0))).otherwise(F.col("_start"))
        rest = F.when(last, F.lit(0)).otherwise(whole - F.col("_end"))
        others = F.concat(F.substring("_all", F.lit(1), kept), F.substring("_all", F.col("_end") + 1, rest)).cast("string")
    lists = ids.select(key, "_all", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("_part"))
    pieces = F.ceil(F.col("n_members") * F.col("n_members") / LIST_IDS)
    dealt = members.withColumn("_part", F.pmod(F.xxhash64("id"), pieces)).repartition(parts, key, "_part")
    return dealt.join(lists.repartition(parts, key, "_part"), [key, "_part"]).select(
        F.lit("temporal_variant").alias("track"),
        F.col("id").alias("query_dataset_id"),
        F.col("title").alias("query_title"),
        key,
        others.alias("relevant_dataset_ids"),
        (F.col("n_members") - 1).alias("n_relevant"),
        F.lit("rule_based").alias("label_source"),
    )
