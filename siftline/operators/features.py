"""One feature row for each seed record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from . import brands as B


def url_features(domain: Column, url: Column) -> dict[str, Column]:
    return {
        "url_length": F.length(url),
        "domain_length": F.length(domain),
        "subdomain_count": U.subdomain_count(domain),
        "tld": U.tld(domain),
        "suspicious_tokens": U.suspicious_tokens(domain, url),
    }


def content_features() -> dict[str, Column]:
    none = F.array().cast("array<string>")
    return {
        "title": F.col("title"),
        "meta_description": F.col("meta_description"),
        "forms_count": F.coalesce("forms_count", F.lit(0)),
        "has_password_field": F.coalesce("has_password_field", F.lit(False)),
        "external_link_count": F.coalesce(F.size(F.coalesce("external_links", none)), F.lit(0)),
        "links_to_domains": F.coalesce("links_to_domains", none),
        "method": F.col("method"),
        "fetched_at": F.col("fetched_at"),
    }


def features(seeds: DataFrame, content: DataFrame, catalog: B.Catalog) -> DataFrame:
    """seeds left-joined with the content of their domains; content has one row for each domain. Brands are looked for once in
    each domain's text, before it goes to every seed of the domain."""
    own = content.select("domain", "title", "meta_description", "text", "forms_count", "has_password_field", "external_links", "links_to_domains", "method", "fetched_at", F.col("file").alias("content_source_file"))
    own = seeds.select("domain").distinct().join(own, "domain", "left").withColumn("text", F.coalesce("text", F.lit("")))
    read = F.concat_ws(" ", "text", F.coalesce("title", F.lit("")))
    own = own.withColumn("found", B.matches(catalog, F.col("domain"), read))
    df = seeds.select("record_id", "url", "domain", "label", "source").join(own, "domain", "left").withColumn("text", F.coalesce("text", F.lit("")))
    none = F.array().cast(own.schema["found"].dataType)
    return df.select("record_id", "url", "domain", "label", "source", *(c.alias(k) for k, c in url_features(F.col("domain"), F.col("url")).items()), F.coalesce("found", none).alias("brand_matches"), F.length("text").alias("text_length"), "text", "content_source_file", *(c.alias(k) for k, c in content_features().items()))


def feature_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("text") == "").alias("missing_text"))
