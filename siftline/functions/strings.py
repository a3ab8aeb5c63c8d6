"""Text column functions: white space, mojibake, noise lines, squashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import NOISE_PATTERNS, PARKING_PATTERNS


def any_of(patterns: list[str], flags: str = "(?iuU)") -> str:
    """One regular expression that finds what any of the patterns finds."""
    return flags + "|".join(f"(?:{p})" for p in patterns)


#: White space as Unicode has it.
BLANKS = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Without white space, as Unicode has it, at both ends. It takes time in proportion to what goes, however long."""
    return F.btrim(c, F.lit(BLANKS))


def let(value: Column, body) -> Column:
    """body of value, which is worked out once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def collapse_whitespace(c: Column) -> Column:
    """Line breaks and runs of blanks become one blank; tabs stay."""
    return strip(F.regexp_replace(F.regexp_replace(c, "[\\r\\n]+", " "), " {2,}", " "))


def unescape(c: Column) -> Column:
    """The common named entities as characters."""
    for name, char in (("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    return c


def squash(c: Column) -> Column:
    """Lower-cased, with nothing left but a-z and 0-9."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def latin_share(c: Column) -> Column:
    """The share of characters from U+0080 to U+00FF; 0 for an empty text."""
    return F.when(F.length(c) > 0, F.length(F.regexp_replace(c, "[^\\x{80}-\\x{ff}]+", "")) / F.length(c)).otherwise(0.0)


def looks_mojibake(c: Column, min_length: int = 0) -> Column:
    return (F.length(c) >= min_length) & (latin_share(c) > 0.30)


def fix_mojibake(c: Column, min_length: int = 10) -> Column:
    """UTF-8 that was read as Latin-1 is read again; texts that don't look so, or can't have been, stay."""
    fits = ~c.rlike("[^\\x{0}-\\x{ff}]")
    again = F.call_function("make_valid_utf8", F.encode(F.when(fits, c), "ISO-8859-1").cast("string"))
    return F.when(looks_mojibake(c, min_length) & fits, again).otherwise(c)


def letter_share(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "\\P{L}", "")) / F.greatest(F.length(c), F.lit(1))


def is_noise(line: Column, patterns: list[str] = NOISE_PATTERNS) -> Column:
    """A boilerplate line, a stripped one of under 3 characters, or one of under 3 letters in 10 characters."""
    return line.rlike(any_of(patterns)) | (F.length(strip(line)) < 3) | (letter_share(line) < 0.3)


def clean_text(c: Column, patterns: list[str] = NOISE_PATTERNS) -> Column:
    """Stripped lines without empty and noise lines."""
    lines = F.transform(F.split(c, "\n"), strip)
    return F.array_join(F.filter(lines, lambda x: (x != "") & ~is_noise(x, patterns)), "\n")


def is_parking(html: Column, patterns: list[str] = PARKING_PATTERNS, first: int = 5000) -> Column:
    return F.lower(F.substring(html, 1, first)).rlike(any_of(patterns))


def too_large(html: Column, most: int = 10 * 1024 * 1024) -> Column:
    return F.octet_length(html) > most


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "(?U)\\s+"), lambda x: x != ""))


def has_form_signal(html: Column) -> Column:
    return html.rlike("(?i)<form\\b|type=[\"']?password")


def iso_utc(ts: Column) -> Column:
    """A time in a UTC session, in seconds, with +00:00."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
