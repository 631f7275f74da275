"""Truthiness, numbers, time stamps, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL name space of RFC 4122, used for name-based identifiers.
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DATE_STAMP = "yyyyMMdd"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truthy(c: str | Column) -> Column:
    """A string that is neither NULL nor empty, else NULL."""
    return F.nullif(col(c), F.lit(""))


def first_truthy(*cols: str | Column) -> Column:
    """First string that is neither NULL nor empty; NULL when there is none."""
    return F.coalesce(*[truthy(c) for c in cols])


def first_nonzero(*cols: str | Column) -> Column:
    """The numeric form of :func:`first_truthy`: zero counts as absent."""
    return F.coalesce(*[F.nullif(col(c), F.lit(0)) for c in cols])


def usable_id() -> Column:
    """Identifier of a raw catalogue record: id, then slug, then uuid."""
    return first_truthy("id", "slug", "uuid")


def parse_number(c: str | Column) -> Column:
    """``"1,200,000"`` or ``"12.5"`` to double; anything else to NULL."""
    return F.regexp_replace(F.trim(col(c)), ",", "").try_cast("double")


def parse_time(c: str | Column) -> Column:
    """ISO text, with or without an offset, to timestamp; anything else to NULL."""
    return col(c).try_cast("timestamp")


def iso_utc(c: str | Column) -> Column:
    return F.date_format(col(c), ISO_UTC)


def date_stamp(c: str | Column) -> Column:
    return F.date_format(col(c), DATE_STAMP)


def uuid5(c: str | Column) -> Column:
    """Name-based (version 5) identifier in the URL name space."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), F.encode(col(c), "UTF-8")))
    variant = F.lower(
        F.hex(
            F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
        )
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def score4(c: str | Column) -> Column:
    return F.round(col(c), 4)


def score3(c: str | Column) -> Column:
    return F.round(col(c), 3)
