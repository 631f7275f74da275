"""Latest-snapshot feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.values import parse_number
from shelfmark.operators.rank import first_per_key


def latest_per_key(
    readings: DataFrame, keys: Sequence[str], time: str, tie: str = "id"
) -> DataFrame:
    """Newest reading of every key; of equally new ones the greatest ``tie``."""
    return first_per_key(readings, keys, [F.col(time).desc_nulls_last(), F.col(tie).desc()])


def rates_of_day(rates: DataFrame, day: Column | str, key: str = "currency_id") -> DataFrame:
    """The newest rate per currency among those valid on ``day``."""
    day = F.lit(day).cast("date") if isinstance(day, str) else day
    return latest_per_key(rates.where(F.col("valid_date") == day), [key], "created_at")


def typed_numbers(df: DataFrame, *columns: str) -> DataFrame:
    """Add ``<column>_number`` for formatted numeric text; the text stays."""
    for c in columns:
        df = df.withColumn(f"{c}_number", parse_number(c))
    return df
