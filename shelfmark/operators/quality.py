"""Valid and rejected rows, requested keys, submitted forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.text import strip_space

# Error names and messages by feed.
ERROR_PARAMS = "ERROR_PARAMS"
ERROR_NOT_FOUND = "REAL_TIME_API_DATA_NOT_FOUND"
FEEDS = {
    "exchange_rate": {
        "domain": schemas.CURRENCIES,
        "invalid": "Invalid currency_id",
        "missing": "There is no today rate for this currency yet.",
        "empty": "There is no today rate yet.",
    },
    "weather": {
        "domain": schemas.PROVINCES,
        "invalid": "Invalid province",
        "missing": "Weather data not found",
        "empty": "Weather data not found",
    },
    "aqi": {
        "domain": schemas.PROVINCES,
        "invalid": "Invalid province",
        "missing": "AQI data not found",
        "empty": "AQI data not found",
    },
    "uv": {
        "domain": schemas.PROVINCES,
        "invalid": "Invalid province",
        "missing": "UV data not found",
        "empty": "UV data not found",
    },
    "csx_index": {"domain": None, "missing": "CSX index data not found", "empty": "CSX index data not found"},
    "csx_summary": {"domain": None, "missing": "CSX summary data not found", "empty": "CSX summary data not found"},
}

# Accepted phone lengths and the shape of a mail address.
PHONE_LENGTH = (9, 15)
EMAIL = r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)+$"

# A rule: field, message, error type, condition that must hold (NULL counts as failed).
Rule = tuple[str, str, str, Column]


def required(*fields: str) -> list[Rule]:
    return [(f, "Field required", "missing", F.col(f).isNotNull()) for f in fields]


def with_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors``: an array of (loc, msg, type), empty for a valid row."""
    found = [
        F.when(
            ~F.coalesce(ok, F.lit(False)),
            F.struct(F.lit(loc).alias("loc"), F.lit(msg).alias("msg"), F.lit(kind).alias("type")),
        )
        for loc, msg, kind, ok in rules
    ]
    return df.withColumn("errors", F.array_compact(F.array(*found)))


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors)."""
    checked = with_errors(df, rules)
    ok = F.size("errors") == 0
    return checked.where(ok).drop("errors"), checked.where(~ok)


def typed_lines(raw: DataFrame, schema: str, body: str = "raw") -> DataFrame:
    """JSON text to typed columns; text that does not fit keeps its body in _corrupt_record."""
    row = F.from_json(
        body,
        schema + ", _corrupt_record string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    return raw.withColumn("_r", row).select(*raw.columns, "_r.*")


def submission_rules() -> list[Rule]:
    rules: list[Rule] = []
    for f in ("first_name", "last_name", "message"):
        rules.append(
            (f, "String should have at least 1 character", "string_too_short", F.length(strip_space(f)) > 0)
        )
    rules.append(("email", "value is not a valid email address", "value_error", F.col("email").rlike(EMAIL)))
    low, high = PHONE_LENGTH
    rules.append(
        ("phone", f"String should have between {low} and {high} characters", "string_length",
         F.length("phone").between(low, high))
    )
    return rules


def validate_submissions(df: DataFrame) -> DataFrame:
    """Names and message trimmed, every row with its list of errors."""
    checked = with_errors(df, submission_rules())
    for f in ("first_name", "last_name", "message"):
        checked = checked.withColumn(f, strip_space(f))
    return checked


def domain_table(spark: SparkSession, values: Sequence[str], key: str) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], f"{key} string")


def key_status(
    requested: DataFrame, readings: DataFrame, key: str, feed: str, domain: DataFrame | None = None
) -> DataFrame:
    """Requested keys with the outcome of the lookup: status, error_name, error_msg.

    ``readings`` holds the latest row per key. A key outside the domain is a bad parameter;
    a known one without a reading is not found. The domain is a fixed short list.
    """
    texts = FEEDS[feed]
    found = readings.select(F.col(key), F.lit(True).alias("_found"))
    out = requested.join(found, key, "left")
    if domain is None and texts["domain"] is not None:
        domain = domain_table(requested.sparkSession, texts["domain"], key)
    if domain is None:
        out = out.withColumn("_known", F.lit(True))
    else:
        known = domain.select(F.col(key), F.lit(True).alias("_known"))
        out = out.join(F.broadcast(known), key, "left")
    bad, ok = F.col("_known").isNull(), F.col("_found").isNotNull()
    name = F.when(bad, ERROR_PARAMS).when(~ok, ERROR_NOT_FOUND)
    message = F.when(bad, texts.get("invalid", "")).when(~ok, texts["missing"])
    return (
        out.withColumn("status", F.when(bad, 400).when(~ok, 404).otherwise(200))
        .withColumn("error_name", name)
        .withColumn("error_msg", message)
        .drop("_found", "_known")
    )


def feed_status(readings: DataFrame, feed: str) -> DataFrame:
    """One row: does the feed hold anything, and the error to give when not."""
    some = F.count(F.lit(1)) > 0
    return readings.agg(
        F.when(some, 200).otherwise(404).alias("status"),
        F.when(~some, ERROR_NOT_FOUND).alias("error_name"),
        F.when(~some, FEEDS[feed]["empty"]).alias("error_msg"),
    )
