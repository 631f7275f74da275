"""Text normalisation used by titles, column names and profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.values import col

# Word edges are spelled out so that combining signs of any script count as
# non-word characters whatever the JVM's own \b does.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\p{Z}]"
YEAR_RANGE = rf"(?<!{WORD})\p{{Nd}}{{4}}{SPACE}*-{SPACE}*\p{{Nd}}{{4}}(?!{WORD})"
YEAR = rf"(?<!{WORD})(?:fy{SPACE}*)?\p{{Nd}}{{4}}(?!{WORD})"
LANGUAGE_SUFFIX = r"(_en|_kh|_km)$"
SPACE_CHARACTERS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
KHMER_BLOCK = r"[\x{1780}-\x{17FF}]+"
LOCAL_SUFFIX = "_kh"

# Column names that mean the same thing.
COLUMN_ALIASES = {
    "ref_year": "year",
    "ref_month": "month",
    "month_num": "month",
    "ref_quarter": "quarter",
    "partner_country_en": "country_partner",
    "country_partner_en": "country_partner",
    "province_en": "province",
    "capital_province": "province",
}


def strip_space(c: str | Column) -> Column:
    return F.btrim(col(c), F.lit(SPACE_CHARACTERS))


def normalize_title(c: str | Column) -> Column:
    """Title without years and punctuation; also the key of a dataset's series."""
    text = F.regexp_replace(F.lower(col(c)), YEAR_RANGE, " ")
    text = F.regexp_replace(text, YEAR, " ")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def strip_script(c: str | Column, block: str = KHMER_BLOCK) -> Column:
    """Drop runs of one script, collapse white space; NULL becomes empty."""
    text = F.regexp_replace(F.coalesce(col(c), F.lit("")), block, " ")
    return F.trim(F.regexp_replace(text, rf"{SPACE}+", " "))


def normalize_column(c: str | Column) -> Column:
    """Column name in canonical spelling, aliases resolved."""
    text = F.regexp_replace(strip_space(F.lower(col(c))), LANGUAGE_SUFFIX, "")
    text = F.btrim(F.regexp_replace(text, "[^a-z0-9]+", "_"), F.lit("_"))
    aliases = F.create_map(*[F.lit(x) for pair in COLUMN_ALIASES.items() for x in pair])
    # A lambda variable, so that the name is worked out once and not once per use.
    named = F.transform(F.array(text), lambda t: F.coalesce(F.try_element_at(aliases, t), t))
    return F.get(named, F.lit(0))


def is_local_column(c: str | Column) -> Column:
    """Columns that repeat another one in the local script."""
    return F.endswith(col(c), F.lit(LOCAL_SUFFIX))


def words(c: str | Column) -> Column:
    """Distinct words of a text split at white space."""
    return F.array_remove(F.array_distinct(F.split(col(c), rf"{SPACE}+")), "")


def join_names(names: Column, keep_empty: bool = False) -> Column:
    """Names without local script, joined with commas.

    Profiles leave empty names out, vector payloads keep them.
    """
    cleaned = F.transform(names, lambda n: strip_script(n))
    if not keep_empty:
        cleaned = F.filter(cleaned, lambda n: n != F.lit(""))
    return F.array_join(cleaned, ", ")


def semantic_string(title: str | Column, description: str | Column) -> Column:
    """``title: description``; a missing description leaves the title alone."""
    text = F.concat(col(title), F.lit(": "), F.coalesce(col(description), F.lit("")))
    return F.btrim(text, F.lit(" :"))
