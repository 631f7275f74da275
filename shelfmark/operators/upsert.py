"""Resume, merge and compare runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.operators.rank import last_wins
from shelfmark.session import durable

# Partition columns of a keyed table: how many buckets it has, and the bucket of a row's key.
OF, BUCKET = "_of", "_bucket"
BUCKETS = 64


def pending(todo: DataFrame, done: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Rows still to do: not done yet, or done with an error."""
    keys = list(keys)
    if "error" in done.columns:
        done = done.where(F.col("error").isNull() | (F.col("error") == ""))
    # Repeats on the done side do not matter to an anti join, so they are not removed first.
    return todo.join(done.select(*keys), keys, "left_anti")


def merge_runs(earlier: DataFrame, later: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """One row per key over both runs; the later run replaces the earlier."""
    both = earlier.withColumn("_run", F.lit(0)).unionByName(
        later.withColumn("_run", F.lit(1)), allowMissingColumns=True
    )
    return last_wins(both, keys, "_run").drop("_run")


def _bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        # nothing has been written there yet
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a keyed table, or None where there is none yet."""
    found = _stored(spark, path)
    return None if found is None else found.drop(OF, BUCKET)


def rows_beside(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame | None:
    """Rows of a keyed table in the buckets that the keys of ``new`` fall into; no other is read."""
    found = _stored(spark, path)
    if found is None:
        return None
    buckets = found.select(OF).first()[0]
    # one number per bucket at most comes back
    touched = [r[0] for r in new.select(_bucket_of(list(keys), buckets)).distinct().collect()]
    return found.where(F.col(BUCKET).isin(touched))


def upsert_table(
    spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str] = ("id",), buckets: int = BUCKETS
) -> None:
    """Write ``new`` (each key once) over the keyed table at ``path``.

    Keys are dealt into buckets, each a partition of the table, and only the buckets that
    ``new`` touches are read and overwritten; the files of all others stay. So an upsert
    costs as much as the buckets it touches. Rows with a null key are left out. A run that
    is repeated with the same rows leaves the same table. ``buckets`` counts for a new table;
    choose it so that one bucket is work for one task.
    """
    keys = list(keys)
    new = durable(new.dropna(subset=keys))
    old = rows_beside(spark, path, new, keys)
    if old is not None:
        buckets = old.select(OF).first()
        buckets = (buckets or _stored(spark, path).select(OF).first())[0]
        rest = old.drop(OF, BUCKET).join(new.select(*keys), keys, "left_anti")
        new = rest.unionByName(new, allowMissingColumns=True)
    placed = new.withColumn(OF, F.lit(buckets)).withColumn(BUCKET, _bucket_of(keys, buckets))
    (
        placed.repartition(BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(OF, BUCKET)
        .parquet(path)
    )


def checked_vectors(new: DataFrame, dim: int) -> DataFrame:
    """``new``; a vector that is null or not of length ``dim`` fails the job with its id.

    :func:`rejected_vectors` lists such rows beforehand.
    """
    wrong = F.concat(F.lit(f"vector is not of length {dim}: id "), F.col("id").cast("string"))
    fits = F.coalesce(F.size("vector") == dim, F.lit(False))
    return new.withColumn("vector", F.when(fits, F.col("vector")).otherwise(F.raise_error(wrong)))


def upsert_vectors(existing: DataFrame, new: DataFrame, dim: int | None = None) -> DataFrame:
    """Keyed vectors after writing ``new`` over ``existing``, with ``dim`` as in
    :func:`checked_vectors`. For a stored table see :func:`upsert_table`."""
    return merge_runs(existing, new if dim is None else checked_vectors(new, dim))


def rejected_vectors(new: DataFrame, dim: int) -> DataFrame:
    """New rows whose vector can't be stored, with the reason: the columns of ``new``, reason."""
    n = F.size("vector")
    reason = F.when(F.col("vector").isNull(), "no vector").when(
        n != dim, F.concat(F.lit("length "), n.cast("string"), F.lit(f" instead of {dim}"))
    )
    return new.withColumn("reason", reason).where(F.col("reason").isNotNull())


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """What changed between two snapshots: key, old and new value, change, delta."""
    o = old.select(F.col(key), F.col(value).alias("old_value"), F.lit(True).alias("_o"))
    n = new.select(F.col(key), F.col(value).alias("new_value"), F.lit(True).alias("_n"))
    both = o.join(n, key, "full_outer")
    same = F.col("old_value").eqNullSafe(F.col("new_value"))
    change = (
        F.when(F.col("_o").isNull(), "added")
        .when(F.col("_n").isNull(), "removed")
        .when(same, "unchanged")
        .otherwise("changed")
    )
    delta = F.coalesce("new_value", F.lit(0)) - F.coalesce("old_value", F.lit(0))
    return both.withColumn("change", change).withColumn("delta", delta).drop("_o", "_n")


def updated_since(df: DataFrame, cutoff: str, column: str = "updated_at") -> DataFrame:
    """Rows changed after ``cutoff``; rows without a time are dropped.

    On a timestamp column the comparison reaches the file scan.
    """
    kind = df.schema[column].dataType.typeName()
    if kind == "string":
        return df.where(F.col(column).try_cast("timestamp") > F.lit(cutoff).cast("timestamp"))
    return df.where(F.col(column) > F.lit(cutoff).cast(kind))
