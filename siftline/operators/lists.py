"""Domain lists: cleaning, with counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import allowed_domain, listed_domain


def cleaned(lines: DataFrame, blacklist: bool = True, value: str = "value") -> DataFrame:
    """The sorted distinct domains of a list's lines."""
    return lines.select(listed_domain(F.col(value)).alias("domain")).where(allowed_domain(F.col("domain"), blacklist)).distinct().orderBy("domain")


def clean_stats(lines: DataFrame, blacklist: bool = True, value: str = "value") -> DataFrame:
    """original, ignored, merged (repeats) and remaining. Domains are counted once for each, so no row moves whole."""
    d = lines.select(listed_domain(F.col(value)).alias("d")).select(F.when(allowed_domain(F.col("d"), blacklist), F.col("d")).alias("domain"))
    each = d.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
    kept, gone = F.col("domain").isNotNull(), F.col("domain").isNull()
    sums = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("original"), F.coalesce(F.sum(F.when(gone, F.col("n"))), F.lit(0)).alias("ignored"), F.count_if(kept).alias("remaining"))
    return sums.select("original", "ignored", (F.col("original") - F.col("ignored") - F.col("remaining")).alias("merged"), "remaining")
