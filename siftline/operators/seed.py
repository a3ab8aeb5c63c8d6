"""The seed set: ranked blacklist domains and listed legitimate ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import bare_domain, canonical_url, record_id
from ..functions.values import CRAWLED_EVIDENCE, OFFICIAL_EVIDENCE
from . import brands as B
from .relational import append_if_short, ordered_distinct


def content_index(pages: DataFrame) -> DataFrame:
    """Of each domain the first page with text, by file and line; pages has PAGE_TEXT's columns, file and line_no."""
    domain = bare_domain(F.coalesce(F.when(F.col("url") != "", F.col("url")), *([F.col("domain")] if "domain" in pages.columns else []), F.lit("")))
    own = pages.withColumn("domain", domain).where((F.col("domain") != "") & (F.col("text") != ""))
    rest = [c for c in own.columns if c != "domain"]
    return own.groupBy("domain").agg(F.min_by(F.struct(*rest), F.struct("file", "line_no")).alias("x")).select("domain", "x.*")


def domains_of(lines: DataFrame) -> DataFrame:
    """domain and line_no of the distinct domains of a list (line_no, value), where each comes first."""
    return ordered_distinct(lines.select(bare_domain(F.col("value")).alias("domain"), "line_no").where("domain != ''"), "domain", "line_no")


def ranked(blacklist: DataFrame, crawled: DataFrame, catalog: B.Catalog) -> DataFrame:
    """Blacklist domains with matches, has_content and score: 0 brand and content, 1 brand, 2 content, 3 neither."""
    own = domains_of(blacklist).withColumn("matches", B.matches(catalog, F.col("domain"), F.lit("")))
    own = own.join(crawled.select("domain", F.lit(True).alias("has_content")).distinct(), "domain", "left").withColumn("has_content", F.coalesce("has_content", F.lit(False)))
    brand = F.size("matches") > 0
    score = F.when(brand & F.col("has_content"), 0).when(brand, 1).when(F.col("has_content"), 2).otherwise(3)
    return own.withColumn("score", score)


def phishing_rows(scored: DataFrame, n: int, list_name: str, source_ref: str | None = None, observed_at: str | None = None) -> DataFrame:
    top = scored.orderBy("score", "domain").limit(n)
    found = F.flatten(F.transform("matches", lambda m: m["evidence"]))
    every = F.concat(F.array(F.lit(f"listed in local {list_name}")), F.when(F.col("has_content"), F.array(F.lit(CRAWLED_EVIDENCE))).otherwise(F.array().cast("array<string>")), found)
    return _rows(top, 1, "local_blacklist", F.array_sort(F.array_distinct(every)), source_ref, observed_at, F.struct("score", "domain"))


def legitimate_domains(whitelist: DataFrame, brands: DataFrame, n: int) -> DataFrame:
    """domain and pos of the whitelist's domains, and behind them the catalog's if fewer than n are listed."""
    listed = whitelist.select(bare_domain(F.col("value")).alias("domain"), F.struct(F.lit(0).alias("part"), F.col("line_no").cast("long").alias("a"), F.lit(0).alias("b")).alias("pos"))
    official = brands.select("brand_no", F.posexplode("official_domains").alias("b", "d")).select(bare_domain(F.col("d")).alias("domain"), F.struct(F.lit(1).alias("part"), F.col("brand_no").cast("long").alias("a"), "b").alias("pos"))
    return ordered_distinct(append_if_short(listed, official, F.col("domain") != "", n).where("domain != ''"), "domain", "pos")


def legitimate_rows(domains: DataFrame, n: int, source_ref: str | None = None, observed_at: str | None = None) -> DataFrame:
    return _rows(domains.orderBy("pos").limit(n), 0, "brand_catalog_official_domains", F.array(F.lit(OFFICIAL_EVIDENCE)), source_ref, observed_at, F.col("pos"))


def _rows(df: DataFrame, label: int, source: str, evidence: Column, source_ref: str | None, observed_at: str | None, order: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    return df.orderBy(order).select(
        record_id(F.lit(label), F.col("domain")).alias("record_id"),
        canonical_url(F.col("domain")).alias("url"),
        null.alias("final_url"),
        "domain",
        F.lit(label).alias("label"),
        F.lit(source).alias("source"),
        F.lit(source_ref).cast("string").alias("source_ref"),
        null.alias("html_path"),
        null.alias("screenshot_path"),
        F.lit(observed_at).cast("string").alias("observed_at"),
        evidence.alias("evidence"),
    )


def seed(blacklist: DataFrame, whitelist: DataFrame, brands: DataFrame, crawled: DataFrame, phishing: int = 75, legitimate: int = 75, list_name: str = "blacklist.txt", observed_at: str | None = None) -> DataFrame:
    """Phishing rows, then legitimate rows."""
    bad = phishing_rows(ranked(blacklist, crawled, B.catalog(brands)), phishing, list_name, observed_at=observed_at)
    good = legitimate_rows(legitimate_domains(whitelist, brands, legitimate), legitimate, observed_at=observed_at)
    return bad.unionByName(good)


def seed_stats(seeds: DataFrame, crawled: DataFrame) -> DataFrame:
    """records, phishing, legitimate and phishing_with_text."""
    own = seeds.join(crawled.select("domain", F.lit(True).alias("has")).distinct(), "domain", "left")
    return own.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("label") == 1).alias("phishing"), F.count_if(F.col("label") == 0).alias("legitimate"), F.count_if((F.col("label") == 1) & F.col("has")).alias("phishing_with_text"))
