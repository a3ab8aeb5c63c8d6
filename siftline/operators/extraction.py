"""Page texts from crawled pages, and the counts of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_text
from ..functions.strings import looks_mojibake


def extracted(pages: DataFrame) -> DataFrame:
    """PAGE_TEXT's columns from RAW_HTML's; html crosses to Python once."""
    own = pages.select("url", F.coalesce("source", F.lit("unknown")).alias("source"), page_text(F.col("url"), F.col("html")).alias("x"), "method", "fetched_at")
    return own.select("url", "source", "x.title", "x.meta_description", "x.text", "x.text_length", "x.forms_count", "x.has_password_field", "x.external_links", "x.links_to_domains", "method", "fetched_at", "x.error")


def extract_stats(pages: DataFrame, malformed: str | None = None) -> DataFrame:
    """processed, errors (malformed lines, which are not processed, and rows without html) and mojibake_fixed."""
    bad = F.col(malformed) if malformed else F.lit(False)
    empty = F.coalesce(F.col("html") == "", F.lit(True))
    fixed = ~bad & ~empty & looks_mojibake(F.col("html"), 10) & ~F.col("html").rlike("[^\\x{0}-\\x{ff}]")
    return pages.agg(F.count_if(~bad).alias("processed"), F.count_if(bad | empty).alias("errors"), F.count_if(fixed).alias("mojibake_fixed"))
