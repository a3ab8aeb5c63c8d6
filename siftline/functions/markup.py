"""Items of list pages by patterns, and page features without a parser: all of it columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import collapse_whitespace, unescape
from .urls import domain_only
from .values import ALLOWED_LINK, DENIED_TEXT, EMBEDDED_PAIR, SCAM_ITEM, TRUSTED_ITEM, TRUSTED_LINK


def _all(html: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(html, F.lit("(?s)" + pattern), F.lit(group))


def _domains(found: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, domain_only), lambda d: d != "")))


def scam_items(html: Column) -> Column:
    return _domains(_all(html, SCAM_ITEM))


def trusted_items(html: Column) -> Column:
    return _domains(F.array_union(_all(html, TRUSTED_LINK), _all(html, TRUSTED_ITEM)))


def report_items(html: Column) -> Column:
    """Of a deny or allow list: its texts, its links and both members of its embedded pairs."""
    return _domains(F.flatten(F.array(_all(html, DENIED_TEXT), _all(html, ALLOWED_LINK), _all(html, EMBEDDED_PAIR, 1), _all(html, EMBEDDED_PAIR, 2))))


def page_count(html: Column, most: int | None = None) -> Column:
    """The greatest page number that a page links to, 1 without any."""
    n = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(html, F.lit("page=(\\d+)"), F.lit(1)), lambda x: x.cast("int"))), F.lit(1))
    return n if most is None else F.least(n, F.lit(most))


def title(html: Column) -> Column:
    found = F.regexp_extract_all(html, F.lit("(?is)<title[^>]*>(.*?)</title>"), F.lit(1))
    return collapse_whitespace(unescape(F.get(found, F.lit(0))))


def forms_count(html: Column) -> Column:
    return F.regexp_count(html, F.lit("(?i)<form\\b"))
