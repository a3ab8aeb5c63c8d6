"""What becomes of a fetch, from tables of answers: the choice of scheme, the archive, the gate and liveness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import parsed
from ..functions.strings import has_form_signal
from ..functions.values import NO_SNAPSHOT


def resolved(dns: DataFrame) -> DataFrame:
    """domain and dns_ok: whether any resolver knows it."""
    return dns.groupBy("domain").agg(F.bool_or("ok").alias("dns_ok"))


def direct(http: DataFrame) -> DataFrame:
    """domain, status_code and html of direct answers (domain, scheme, attempt, status_code, body).

    https comes before http. A scheme's second attempt counts only after 429 or 503. The first answer below 400 is
    taken; without one the last status stays.
    """
    h = http.where("status_code IS NOT NULL").withColumn("rank", F.when(F.col("scheme") == "https", 0).otherwise(1) * 2 + F.col("attempt"))
    retried = h.where("attempt = 0 AND status_code IN (429, 503)").select("domain", "scheme", F.lit(True).alias("again"))
    h = h.join(retried, ["domain", "scheme"], "left").where("attempt = 0 OR again")
    ok = F.when(F.col("status_code") < 400, F.struct("rank", "status_code", "body"))
    each = h.groupBy("domain").agg(F.min_by(ok, F.when(ok.isNotNull(), F.col("rank"))).alias("ok"), F.max_by("status_code", "rank").alias("last"))
    return each.select("domain", F.coalesce("ok.status_code", "last").alias("status_code"), F.col("ok.body").alias("html"))


def outcomes(domains: DataFrame, dns: DataFrame, http: DataFrame, archive: DataFrame, min_words: int = 50) -> DataFrame:
    """url, html, method, status_code and error of each domain; archive has domain, closest_status and body.

    Pages under min_words words fail unless they have a form or a password field. A body of "" is a page of 0 words when
    it came directly, and no page when it came from the archive.
    """
    empty = domains.where(F.col("domain") == "").select("domain", F.lit("empty domain").alias("error"))
    got = domains.where(F.col("domain") != "").join(resolved(dns), "domain", "left").join(direct(http), "domain", "left")
    got = got.withColumns({c: F.when(F.col("dns_ok"), F.col(c)) for c in ("status_code", "html")})
    old = archive.where((F.col("closest_status") == "200") & (F.col("body") != "")).select("domain", F.col("body").alias("old"))
    got = got.join(old, "domain", "left")
    html = F.coalesce("html", "old")
    method = F.when(F.col("html").isNotNull(), "direct").when(F.col("old").isNotNull(), "wayback")
    status = F.when(F.col("html").isNull() & F.col("old").isNotNull(), 200).otherwise(F.col("status_code"))
    got = got.select("domain", html.alias("html"), method.alias("method"), status.alias("status_code"))
    words = F.coalesce(parsed(F.col("html"))["words"], F.lit(0))
    got = got.withColumn("words", words)
    short = F.col("html").isNotNull() & (F.col("words") < min_words) & ~has_form_signal(F.col("html"))
    said = F.concat(F.lit("HTML content too short ("), F.col("words").cast("string"), F.lit(f" words, minimum required is {min_words})"))
    error = F.when(F.col("html").isNull(), NO_SNAPSHOT).when(short, said)
    out = got.select(F.col("domain").alias("url"), F.when(~short, F.col("html")).alias("html"), F.when(error.isNotNull(), "failed").otherwise(F.col("method")).alias("method"), "status_code", error.alias("error"))
    return out.unionByName(empty.withColumnRenamed("domain", "url"), allowMissingColumns=True)


def fetch_stats(fetched: DataFrame) -> DataFrame:
    """total, success and failed."""
    return fetched.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("html").isNotNull()).alias("success"), F.count_if(F.col("html").isNull()).alias("failed"))


def liveness(dns_ok: Column, http_status: Column) -> Column:
    return F.when(~F.coalesce(dns_ok, F.lit(False)), "dead_dns").when((http_status > 0) & (http_status < 400), "alive").otherwise("dead_http")
