"""The cleaning cascade of crawled pages and its counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import parsed
from ..functions.strings import is_parking, strip, too_large
from .relational import first_wins

REASONS = ["kept", "failed_html", "duplicate_url", "too_large", "parking_page", "too_short"]


def with_reason(pages: DataFrame, min_words: int = 200, malformed: str | None = None) -> DataFrame:
    """pages (file, line_no, url, html) with url_key and reason; the first that holds wins.

    A url's first page with html is not a duplicate, whatever becomes of it later; it is found by a minimum over keys
    alone. Pages meet it by (file, line_no), which no hot url can skew. Words are counted only where nothing cheaper has
    decided.
    """
    key = F.lower(strip(F.coalesce("url", F.lit(""))))
    df = pages.withColumn("url_key", key)
    bad = F.col(malformed) if malformed else F.lit(False)
    empty = bad | F.coalesce(F.col("html") == "", F.lit(True))
    first = first_wins(df.where(~empty).select("file", "url_key", "line_no"), ["file", "url_key"], ["line_no"]).select("file", "line_no", F.lit(True).alias("__first"))
    df = df.join(first, ["file", "line_no"], "left")
    cheap = (
        F.when(empty, "failed_html")
        .when(F.col("__first").isNull(), "duplicate_url")
        .when(too_large(F.col("html")), "too_large")
        .when(is_parking(F.col("html")), "parking_page")
    )
    df = df.withColumn("__cheap", cheap)
    words = parsed(F.when(F.col("__cheap").isNull(), F.col("html")))["words"]
    reason = F.coalesce("__cheap", F.when(words < min_words, "too_short"), F.lit("kept"))
    return df.withColumn("reason", reason).drop("__cheap", "__first")


def clean_stats(reasoned: DataFrame, min_words: int = 200) -> DataFrame:
    """One row for each file: total, and how many rows have each reason."""
    return reasoned.groupBy("file").agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("reason") == r).alias(r) for r in REASONS)).withColumn("min_words", F.lit(min_words))


def grand_total(stats: DataFrame) -> DataFrame:
    """All files together, if there are several, with the share kept in per cent; none of no rows."""
    sums = stats.agg(F.count(F.lit(1)).alias("files"), *(F.sum(c).alias(c) for c in ["total", *REASONS]))
    share = F.when(F.col("total") > 0, F.round(100.0 * F.col("kept") / F.col("total"), 1)).otherwise(0.0)
    return sums.where("files > 1").withColumn("kept_percent", share)
