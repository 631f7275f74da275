"""Filter interaction audit: what each filter removes in every order, by a recursive CTE."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.groups import SALT_ROWS, skew_join
from shelfmark.session import durable

BLANKS = "[ \\x09-\\x0D]+"
# Name of the filter for texts that stand under a smaller id as well.
COPY = "E"
MOST_FILTERS = 8


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that one text decides alone."""
    size = F.transform(F.array(_words(text)), lambda w: F.struct(F.size(w), F.size(F.array_distinct(w))))[0]
    n, distinct = size["col1"], size["col2"]
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * distinct < 80 * n,
        "C": 100 * capitals.cast("bigint") > 10 * F.char_length(text).cast("bigint"),
        "D": text.rlike("[#$%&*|]"),
    }


def failed_filters(
    docs: DataFrame,
    filters: Mapping[str, Column],
    id_col: str,
    text_col: str,
    part_col: str,
    copy: str | None = COPY,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """``id``, ``part`` and ``failed`` of every document: bit k set where filter k fails.

    Filters count from bit 0 in the order of ``filters``, ``copy`` after them. A copy is a
    document whose text (null as empty) stands under a smaller id too; a null id is neither
    smaller than any nor a copy. Texts are read once and travel as digests.
    """
    bit = [F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(filters.values())]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        sum(bit, F.lit(0)).cast("int").alias("failed"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    if copy is None:
        return rows.drop("digest")
    rows = durable(rows)
    same = (
        rows.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        .where("n > 1 and first is not null")
    )
    same = durable(same)
    joined = skew_join(
        rows, same.select("digest", "first"), ["digest"], "left",
        counts=same.select("digest", "n"), salt_rows=salt_rows,
    )
    copied = F.when(F.col("id") > F.col("first"), F.lit(1 << len(filters))).otherwise(0)
    return joined.select("id", "part", F.col("failed").bitwiseOR(copied.cast("int")).alias("failed"))


def mask_cells(failed: DataFrame, marks: DataFrame) -> DataFrame:
    """Documents of every part by the set of filters that they fail: part, cells.

    ``marks`` holds ``id``, ``good`` and ``toxic`` (0 or 1), one row per id at most. A cell is
    (mask, n, good, toxic); a part has one per set of filters that some document fails.
    """
    few = failed.groupBy("id", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    known = few.where("id is not null").join(marks, "id", "left").drop("id")
    lost = few.where("id is null").drop("id")
    zero = F.lit(0).cast("int")
    lost = lost.withColumns({"good": zero, "toxic": zero})
    cells = (
        known.select("part", "failed", "n", "good", "toxic")
        .union(lost.select("part", "failed", "n", "good", "toxic"))
        .groupBy("part", F.col("failed").alias("mask"))
        .agg(
            F.sum("n").alias("n"),
            F.coalesce(F.sum(F.col("n") * F.col("good")), F.lit(0)).alias("good"),
            F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("toxic"),
        )
    )
    # one entry per mask, 2 ** filters at most
    cell = F.struct("mask", "n", "good", "toxic")
    return cells.groupBy("part").agg(F.collect_list(cell).alias("cells"))


def _count(of: str, condition: str) -> str:
    """SQL of the documents in the cells that meet a condition on their mask ``c.mask``."""
    return f"aggregate(filter(cells, c -> {condition}), 0L, (s, c) -> s + c.{of})"


def interactions(cells: DataFrame, letters: Sequence[str]) -> DataFrame:
    """One row per part, order of all filters and step, from the cells of :func:`mask_cells`.

    A recursive CTE grows the prefixes of all orders: each level joins a prefix of its part
    with the part's cells and extends it by every letter that is not yet in it. It carries
    the bits of the filters applied, which is all it takes to tell the cells that are gone.
    A prefix is worked out once, however many orders begin with it; the orders then join
    their prefixes, and a filter's removals count once for each order that has them.
    """
    k = len(letters)
    if not 1 <= k <= MOST_FILTERS or len(set(letters)) != k or any(len(x) != 1 for x in letters):
        raise ValueError(f"1 to {MOST_FILTERS} different letters, one character each")
    spark = cells.sparkSession
    named = ", ".join(
        f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters)
    )
    fails, before = "c.mask & bit != 0", "c.mask & applied"
    query = f"""
        WITH RECURSIVE levels AS (
          SELECT part, '' AS prefix, 0 AS done, 0 AS step, '' AS letter,
                 0L AS kept, 0L AS removed, 0L AS redundant, 0L AS unique_fails,
                 0L AS good_lost, 0L AS toxic_lost
          FROM {{cells}}
          UNION ALL
          SELECT part, prefix || letter, applied | bit, step, letter,
                 {_count("n", f"c.mask & (applied | bit) = 0")},
                 {_count("n", f"{fails} AND {before} = 0")},
                 {_count("n", f"{fails} AND {before} != 0")},
                 {_count("n", "c.mask = bit")},
                 {_count("good", f"{fails} AND {before} = 0")},
                 {_count("toxic", f"{fails} AND {before} = 0")}
          FROM (
            SELECT part, prefix, applied, step, cells, next.letter AS letter, next.bit AS bit
            FROM (
              SELECT l.part, l.prefix, l.done AS applied, l.step + 1 AS step, m.cells,
                     explode(filter(array({named}), x -> x.bit & l.done = 0)) AS next
              FROM levels l JOIN {{cells}} m ON l.part = m.part
              WHERE l.step < {k}
            )
          )
        )
        SELECT * FROM levels WHERE step > 0
    """
    # rows are parts times prefixes; the row limit of the setting is for runaway recursion,
    # which the number of letters rules out here
    limit = "spark.sql.cteRecursionRowLimit"
    before_limit = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        levels = durable(spark.sql(query, cells=durable(cells)))
    finally:
        if before_limit is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before_limit)
    orders = levels.where(F.col("step") == k).select(
        "part", F.col("prefix").alias("filter_order"),
        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"),
    ).withColumn("prefix", F.left("filter_order", F.col("step")))
    ways = F.element_at(F.array(*[F.lit(math.factorial(k - s)) for s in range(1, k + 1)]), F.col("step"))
    shares = levels.groupBy("part", "letter").agg(F.sum(F.col("removed") * ways).alias("shapley"))
    steps = levels.drop("step", "done").join(shares, ["part", "letter"])
    return orders.join(steps, ["part", "prefix"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), "kept", "removed", "redundant",
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def audit_filters(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    filters: Mapping[str, Column] | None = None,
    copy: str | None = COPY,
    label_id_col: str = "doc_id",
    good_col: str = "quality",
    toxic_col: str = "toxic",
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """What each of the filters removes at each step of each order, per part.

    ``filters`` maps a letter to a failure condition on ``docs`` (:func:`text_filters` by
    default; a null condition does not fail), and ``copy`` names the filter for copies of a
    text under a smaller id (None: no such filter). One row per part, order and step, zeros
    included: part, filter_order, step (its filter is that letter of the order), and counts
    of documents: kept after the step, removed by it, redundant (failing its filter, but
    removed before), unique_fails (failing it and no other), good_lost and toxic_lost
    (removed by it, labelled 1), shapley (removals of the step's filter over all orders).

    Null and empty texts are the same; a null part is the empty string; rows with a null id
    count, but have no label and are no copies. Repeated rows count each, with the label of
    their id; of several labels of an id one is enough. Other columns are ignored; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    filters = text_filters(text) if filters is None else dict(filters)
    failed = failed_filters(docs, filters, id_col, text_col, part_col, copy, salt_rows)

    def flag(name: str) -> Column:
        return F.max(F.coalesce(F.col(f"`{name}`") == 1, F.lit(False)).cast("int"))

    marks = (
        labels.withColumn(label_id_col, F.col(f"`{label_id_col}`").cast("bigint"))
        .where(F.col(f"`{label_id_col}`").isNotNull())
        .groupBy(F.col(f"`{label_id_col}`").alias("id"))
        .agg(flag(good_col).alias("good"), flag(toxic_col).alias("toxic"))
    )
    letters = [*filters, *([copy] if copy is not None else [])]
    return interactions(mask_cells(failed, marks), letters)
