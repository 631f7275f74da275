"""Session set-up and the few helpers that touch cluster-wide settings."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Upper bound for anything this package ships to every executor.
BROADCAST_BYTES = 128 * 1024 * 1024


def get_spark(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the session names; make one up only for a local run without it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from there.

    Used where one intermediate feeds several branches of a job: it is computed once, a
    lost executor costs a re-read instead of a recomputation, each branch reads only the
    columns it needs, and the planner knows the size of what it joins. Tables stay until
    the Python process ends, or :func:`release` or :func:`release_tables` is called. What was
    shuffled to make a table is deleted once it is written.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    if not _tables:
        atexit.register(_release_quietly, spark)
    _tables.append(path)
    with _shuffles_freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table = path
    return out


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What runs in here leaves no shuffle files; other settings of the session stay as they are."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`durable` that nothing will read again; others are left alone."""
    for df in tables:
        path = getattr(df, "_table", None)
        if path in _tables:
            _tables.remove(path)
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_tables: list[str] = []


def release_tables(spark: SparkSession) -> None:
    """Delete all tables written by :func:`durable`; DataFrames built on them end with that."""
    while _tables:
        _delete(spark, _tables.pop())


def _release_quietly(spark: SparkSession) -> None:
    try:
        release_tables(spark)
    except Exception:  # noqa: BLE001 - the session may be gone at exit
        pass
