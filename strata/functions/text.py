"""Parsers for prices, areas, counts, flags, dates and links."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.config import ASK_MARKERS, BATCH_ID_FORMAT, NOT_AVAILABLE

# Patterns that decide what the digits of a raw text are.
NON_DIGIT = "[^0-9]"
NON_DECIMAL = r"[^0-9\.]"
AREA_SUFFIX = r"(?i)\s*m2\s*$"
FIRST_DIGITS = r"(\d+)"
ES_CO_NUMBER = r"(\d{1,3}(?:\.\d{3})+|\d+)(?:,(\d+))?"
MAIL_DATE = "dd/MM/yyyy"


def _es_co_number(c: Column) -> Column:
    whole = F.regexp_replace(F.regexp_extract(c, ES_CO_NUMBER, 1), r"\.", "")
    part = F.regexp_extract(c, ES_CO_NUMBER, 2)
    return F.when(whole != "", F.concat(whole, F.lit("."), part, F.lit("0")).try_cast("double"))


def parse_price(c: Column, mode: str = "reference") -> Column:
    """Price text to double.

    ``reference`` keeps every digit and nothing else; ``locale`` reads the
    first number with dot as thousands mark and comma as decimal mark.
    """
    if mode == "locale":
        return _es_co_number(c)
    return F.regexp_replace(c, NON_DIGIT, "").try_cast("double")


def parse_area(c: Column, mode: str = "reference") -> Column:
    """Area text to double; see :func:`parse_price` for the modes."""
    if mode == "locale":
        return _es_co_number(c)
    bare = F.regexp_replace(c, AREA_SUFFIX, "")
    return F.regexp_replace(bare, NON_DECIMAL, "").try_cast("double")


def first_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(F.regexp_extract(c, FIRST_DIGITS, 1).try_cast("int"), F.lit(default))


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == NOT_AVAILABLE)


def presence_flag(c: Column) -> Column:
    return F.when(is_missing(c), 0).otherwise(1)


def default_if_missing(c: Column, default: str = "1") -> Column:
    """Text with a text default, so that both branches have one type."""
    return F.when(is_missing(c), F.lit(str(default))).otherwise(c.cast("string"))


def try_int(c: Column) -> Column:
    return c.try_cast("int")


def numeric_text(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def parse_timestamp(c: Column) -> Column:
    """ISO text, else day/month/year; time of day is kept so that it breaks ties."""
    iso = c.try_cast("timestamp_ntz")
    mail = F.try_to_timestamp(c, F.lit(MAIL_DATE)).cast("timestamp_ntz")
    return F.coalesce(iso, mail)


def parse_date(c: Column) -> Column:
    return parse_timestamp(c).cast("date")


def trimmed(names: Iterable[str]) -> dict[str, Column]:
    """Arguments for ``withColumns`` that trim the named columns."""
    return {n: F.trim(F.col(n)) for n in names}


def split_or_empty(c: Column, separator: str = ",") -> Column:
    pieces = F.split(c, r"\Q" + separator + r"\E")
    return F.coalesce(pieces, F.array().cast("array<string>"))


def sentinel(c: Column) -> Column:
    """Site placeholders and blanks to the one text used for "not available"."""
    blank = c.isNull() | F.trim(c).isin(*ASK_MARKERS)
    return F.when(blank, F.lit(NOT_AVAILABLE)).otherwise(F.trim(c))


def unescaped(c: Column) -> Column:
    """Text of an attribute without the entities that links carry."""
    for entity, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(sign))
    return c


def absolute_url(base: Column, href: Column) -> Column:
    """A link with a scheme of any kind stays; one without takes that of the base; a
    missing one is the sentinel; any other is put behind the base."""
    scheme = F.regexp_extract(base, "^[^/]*", 0)
    whole = (F.when(href.rlike("(?i)^[a-z][a-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href))
             .otherwise(F.concat(base, href)))
    return F.when(href.isNull() | (href == ""), F.lit(NOT_AVAILABLE)).otherwise(whole)


def batch_id(ts: Column) -> Column:
    return F.date_format(ts, BATCH_ID_FORMAT)
