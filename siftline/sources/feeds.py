"""Public feeds: the registry, and parsers of their snapshots into source records."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import strip
from ..functions.urls import normalize_domain, normalize_url
from ..operators.relational import first_in_group, first_wins, union_all
from .files import numbered


@dataclass(frozen=True)
class Feed:
    label: int
    kind: str
    url: str
    fallback: str | None = None


# Public feeds, their labels (1 phishing, 0 legitimate, -1 neither) and kinds.
FEEDS = {
    "openphish": Feed(1, "url_list", "https://openphish.com/feed.txt"),
    "phishtank": Feed(1, "phishtank_csv", "https://data.phishtank.com/data/online-valid.csv", "http://data.phishtank.com/data/online-valid.csv"),
    "phishing_database_domains": Feed(1, "domain_list", "https://raw.githubusercontent.com/Phishing-Database/Phishing.Database/master/phishing-domains-ACTIVE.txt"),
    "phishing_database_links": Feed(1, "url_list", "https://raw.githubusercontent.com/Phishing-Database/Phishing.Database/master/phishing-links-ACTIVE.txt"),
    "tranco_top": Feed(0, "tranco_zip", "https://tranco-list.eu/top-1m.csv.zip"),
    "urlhaus_malware": Feed(-1, "url_list", "https://urlhaus.abuse.ch/downloads/text/"),
}
DEFAULT = ["openphish", "phishtank", "phishing_database_domains", "phishing_database_links", "tranco_top"]

#: Where str.splitlines breaks lines.
BREAKS = "\\r\\n|[\\n\\r\\x{0b}\\x{0c}\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]"
EXTRA = ["phish_id", "target", "submission_time", "verification_time"]


def selected(value: str) -> list[str]:
    """Names of `default`, `all` or a comma list; an unknown one is an error."""
    names = {"default": DEFAULT, "all": list(FEEDS)}.get(value.strip()) or [x.strip() for x in value.split(",") if x.strip()]
    if unknown := [n for n in names if n not in FEEDS]:
        raise ValueError(f"unknown feeds: {', '.join(unknown)}")
    return names


def decoded(content: Column) -> Column:
    """Bytes as UTF-8, with U+FFFD for what isn't."""
    return F.call_function("make_valid_utf8", content.cast("string"))


def broken(text: Column) -> Column:
    """Lines with their numbers from 0."""
    return F.posexplode(F.split(text, BREAKS))


def plain_lines(texts: DataFrame, domains_only: bool = False, text: str = "text") -> DataFrame:
    """url, domain, raw_value and line_no (from 1) of a feed's lines, beside the other columns of texts.

    Comments go; of a comma list the last field counts, unless the line is a url; what has no valid domain goes.
    """
    rest = [c for c in texts.columns if c != text]
    v = texts.select(*rest, broken(F.col(text)).alias("n", "v")).withColumn("v", strip(F.col("v"))).where(~F.col("v").rlike("^(#|!|//)") & (F.col("v") != ""))
    field = F.when(F.contains("v", F.lit(",")) & ~F.col("v").rlike("^https?://"), strip(F.element_at(F.split("v", ","), -1))).otherwise(F.col("v"))
    v = v.withColumn("v", field).withColumn("domain", normalize_domain(F.col("v"))).where("domain != ''")
    url = F.concat(F.lit("http://"), "domain") if domains_only else normalize_url(F.col("v"))
    return v.select(*rest, url.alias("url"), "domain", F.col("v").alias("raw_value"), (F.col("n") + 1).cast("int").alias("line_no"))


def csv_records(rows: DataFrame) -> DataFrame:
    """Records of a feed with a header: rows has record_no (from 1), url and EXTRA; line_no counts the header too."""
    url = strip(F.coalesce("url", F.lit("")))
    own = rows.select(url.alias("url"), normalize_domain(url).alias("domain"), url.alias("raw_value"), (F.col("record_no") + 1).cast("int").alias("line_no"), *EXTRA)
    return own.where("domain != ''")


def ranked_records(rows: DataFrame, rank: str = "rank", value: str = "value") -> DataFrame:
    """Records of a ranking without header: rows has line_no, rank and value; a rank that isn't a number is null."""
    d = normalize_domain(F.col(value))
    own = rows.select(F.concat(F.lit("http://"), d).alias("url"), d.alias("domain"), F.col(value).alias("raw_value"), "line_no", F.when(strip(F.col(rank)).rlike("^[0-9]+$"), F.expr(f"try_cast(trim({rank}) AS int)")).alias("rank"))
    return own.where("domain != ''")


@F.arrow_udf(T.StringType())
def first_csv(archives: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The text of a zip archive's first member that ends in .csv."""
    for batch in archives:
        out = []
        for raw in batch.to_pylist():
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                name = next((n for n in z.namelist() if n.endswith(".csv")), None)
                out.append(None if name is None else z.read(name).decode("utf-8", "replace"))
        yield pa.array(out, pa.string())


def snapshot(spark: SparkSession, name: str, path: str, limit: int | None = None) -> DataFrame:
    """Source records of a feed's local snapshot: its first `limit` valid rows."""
    feed = FEEDS[name]
    if feed.kind == "phishtank_csv":
        lines = spark.read.csv(path, header=True, multiLine=True, escape='"')
        own = csv_records(numbered(lines.select("*", "_metadata"), "record_no"))
    elif feed.kind == "tranco_zip":
        text = spark.read.format("binaryFile").load(path).select(first_csv("content").alias("text"))
        fields = text.select(broken(F.col("text")).alias("n", "v")).select((F.col("n") + 1).alias("line_no"), F.split("v", ",").alias("f")).where(F.size("f") >= 2)
        own = ranked_records(fields.select("line_no", F.col("f")[0].alias("rank"), F.col("f")[1].alias("value")))
    else:
        text = spark.read.format("binaryFile").load(path).select(decoded(F.col("content")).alias("text"))
        own = plain_lines(text, feed.kind == "domain_list")
    own = own.withColumns({"source": F.lit(name), "label": F.lit(feed.label)})
    return first_in_group(own, ["source"], ["line_no"], limit)


def collected(spark: SparkSession, snapshots: dict[str, str], limit: int | None = 5000) -> DataFrame:
    """All feeds' records, without repeats of (label, domain, url): the first by feed, then by line, stays."""
    frames = [snapshot(spark, name, path, limit).withColumn("source_no", F.lit(i)) for i, (name, path) in enumerate(snapshots.items())]
    return first_wins(union_all(frames), ["label", "domain", "url"], ["source_no", "line_no"]).drop("source_no")
