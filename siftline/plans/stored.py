"""Queries on what the writers leave and the readers find: whole tables, written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_HTML
from ..session import scratch
from ..sources import files, sinks
from ..streaming import incremental
from .domains import HOST
from .registry import joined, plain, query, shared, table

#: Hosts in several cases, with repeats.
NAMES = f"SELECT CASE WHEN page_id % 3 = 0 THEN upper({HOST}) ELSE {HOST} END AS domain FROM {{pages}} UNION ALL SELECT concat('extra', page_id % 40, '.example') FROM {{pages}}"


@query(f"SELECT row_number() OVER (ORDER BY domain) AS line_no, domain AS value FROM ({plain(NAMES)}) WHERE domain <> ''")
def stored_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list written in order of code points, and its numbered lines."""
    at = scratch(spark, "list") + ".txt"
    sinks.write_domains(shared(spark, sf_dir, NAMES), at)
    return files.domain_lines(spark, at)


@query(f"SELECT DISTINCT lower(domain) AS domain FROM ({plain(NAMES)}) WHERE domain <> ''")
def stored_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list written by lower case, replaced by a longer one, and its distinct domains."""
    at = scratch(spark, "set") + ".txt"
    own = shared(spark, sf_dir, NAMES)
    sinks.write_domains(own.where("domain LIKE 'extra%'"), at, fold_case=True)
    sinks.replace(own.select(F.concat(F.lit("  "), "domain", F.lit("\t\r")).alias("value")), at, backup=True)
    return files.domain_set(spark, at)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def stored_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, line ends included, as JSON lines; halves of them in two appended jobs."""
    at, own = scratch(spark, "records"), table(spark, sf_dir, "documents")
    sinks.write_records(own.where("doc_id % 2 = 0"), at)
    sinks.append_records(own.where("doc_id % 2 <> 0"), at)
    return files.records(spark, at, "doc_id long, text string, lang string, source string, n_chars long").drop("file", "line_no")


#: Lines of a crawl: records with a field that no schema knows, and every seventh one broken off.
_RAW = """SELECT page_id, '{"url":"' || url || CASE WHEN page_id % 7 = 3 THEN '' ELSE '","method":' || CASE WHEN page_id % 2 = 0 THEN 'null' ELSE '"direct"' END || ',"more":[' || page_id || ']}' END AS raw FROM pages"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    line = F.concat(F.lit('{"url":"'), "url", F.lit('","method":'), F.when(F.col("page_id") % 2 == 0, "null").otherwise('"direct"'), F.lit(',"more":['), "page_id", F.lit("]}"))
    return p.select("page_id", F.when(F.col("page_id") % 7 == 3, F.concat(F.lit('{"url":"'), "url")).otherwise(line).alias("raw"))


@query(f"SELECT raw, page_id % 7 = 3 AS malformed, CASE WHEN page_id % 7 <> 3 THEN regexp_extract(raw, '\"url\":\"([^\"]*)', 1) END AS url, CASE WHEN page_id % 7 <> 3 AND page_id % 2 <> 0 THEN 'direct' END AS method FROM ({_RAW})")
def stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as they were read, fields that no schema knows included, and what they tell."""
    at = scratch(spark, "raw")
    sinks.write_raw(_raw(spark, sf_dir), at)
    own = files.records(spark, at, "url string, method string", keep_malformed=True)
    return own.select("raw", "malformed", F.when(~F.col("malformed"), F.col("url")).alias("url"), F.when(~F.col("malformed"), F.col("method")).alias("method"))


@query(f"SELECT row_number() OVER (ORDER BY raw) AS line_no, CASE WHEN page_id % 7 = 3 THEN raw ELSE '{{\"url\":\"' || regexp_extract(raw, '\"url\":\"([^\"]*)', 1) || '\",\"method\":' || CASE WHEN page_id % 2 = 0 THEN 'null' ELSE '\"direct\"' END || ',\"_mojibake_fixed\":true}}' END AS value FROM ({_RAW})")
def stored_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file repaired in its place: malformed lines as they were, in the file's order."""
    at = scratch(spark, "repair") + ".jsonl"
    sinks.replace(_raw(spark, sf_dir).select(F.col("raw").alias("value")).orderBy("value"), at)
    fixed = sinks.repair_records(spark, at, "url string, method string", {"_mojibake_fixed": F.lit(True)})
    sinks.replace(fixed.orderBy("line_no").select("value"), at, backup=True)
    return files.numbered_lines(spark, at).select("line_no", "value")


@query(f"""SELECT CASE page_id % 4 WHEN 0 THEN 'black' WHEN 1 THEN 'white' WHEN 2 THEN 'unknown' END AS list, row_number() OVER (PARTITION BY page_id % 4 ORDER BY raw) AS line_no, raw FROM ({_RAW}) WHERE page_id % 4 <> 3""")
def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled files of a folder, less cleaned ones, with the list that each one's name tells."""
    at, own = scratch(spark, "pages"), _raw(spark, sf_dir)
    for i, name in enumerate(("a_black", "a_white", "other", "a_black_cleaned")):
        sinks.replace(own.where(F.col("page_id") % 4 == i).select(F.col("raw").alias("value")).orderBy("value"), f"{at}/{name}.jsonl")
    return files.raw_pages(spark, at, RAW_HTML, cleaned=False).select("list", "line_no", "raw")


@query("SELECT doc_id, text, source FROM documents WHERE source IS NOT NULL")
def stored_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each source."""
    at = scratch(spark, "sources")
    sinks.write_by_source(table(spark, sf_dir, "documents").where("source IS NOT NULL").select("doc_id", "text", "source"), at)
    return spark.read.schema("doc_id long, text string, source string").json(at)


@query(f"SELECT page_id, {HOST} AS domain, CASE WHEN page_id % 5 = 0 THEN 'a, \"b\"' END AS title FROM pages")
def stored_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with commas, quotes and nulls under a header."""
    at = scratch(spark, "csv")
    own = shared(spark, sf_dir, f"SELECT page_id, url, {HOST} AS domain, CASE WHEN page_id % 5 = 0 THEN 'a, \"b\"' END AS title FROM {{pages}}")
    sinks.write_csv(own, at, ["page_id", "domain", "title"])
    return spark.read.csv(at, header=True, schema="page_id long, domain string, title string")


@query("""SELECT (dense_rank() OVER (ORDER BY r_name) - 1) * 1000000 + row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS brand_no, r_name AS category, n_name AS name,
lower(n_name) || '.example|' || n_nationkey || '.example' AS official_domains, CASE WHEN n_nationkey % 2 = 0 THEN 'n' || n_nationkey END AS aliases, 'sector ' || r_regionkey AS sector FROM nation JOIN region ON n_regionkey = r_regionkey""")
def stored_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog file of nations by region, with keys that aren't brands."""
    at = scratch(spark, "brands") + ".json"
    own = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    domains = F.array(F.concat(F.lower("n_name"), F.lit(".example")), F.concat("n_nationkey", F.lit(".example")))
    brand = F.struct(F.col("n_name").alias("name"), domains.alias("official_domains"), F.when(F.col("n_nationkey") % 2 == 0, F.array(F.concat(F.lit("n"), "n_nationkey"))).alias("aliases"), F.concat(F.lit("sector "), "r_regionkey").alias("sector"))
    each = own.groupBy("r_name").agg(F.to_json(F.array_sort(F.collect_list(brand))).alias("json")).select(F.concat(F.to_json(F.array("r_name")).substr(F.lit(2), F.length(F.to_json(F.array("r_name"))) - 2), F.lit(":"), "json").alias("item"))
    sinks.replace(each.agg(F.concat(F.lit('{"_meta":{"a":1},"other":"text",'), F.array_join(F.array_sort(F.collect_list("item")), ","), F.lit("}")).alias("value")), at)
    read = files.brands(spark, at)
    rank = F.floor(F.col("brand_no") / 1_000_000) - F.lit(1)  # the text under `other` has the first place
    return read.select((rank * 1_000_000 + F.col("brand_no") % 1_000_000).alias("brand_no"), "category", "name", joined("official_domains"), joined("aliases"), "sector")


@query(f"SELECT {HOST} AS domain, count(*) AS pages, count(DISTINCT title) AS titles FROM (SELECT DISTINCT url, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title FROM pages) GROUP BY 1")
def streamed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page twice, in files that a stream reads; each url's text comes once to the sink, which is read back."""
    at, p = scratch(spark, "stream"), table(spark, sf_dir, "pages")
    page = p.select("url", "html", F.lit("2024-01-01T00:00:00+00:00").alias("fetched_at"), F.lit("direct").alias("method"), F.lit("black").alias("source"))
    for _ in range(2):
        sinks.append_records(page, f"{at}/in")
    incremental.extract(incremental.unique_pages(incremental.pages(spark, f"{at}/in")), f"{at}/out", f"{at}/offsets").awaitTermination()
    own = spark.read.schema("url string, title string").json(f"{at}/out")
    return own.groupBy(F.expr(HOST).alias("domain")).agg(F.count(F.lit(1)).alias("pages"), F.count_distinct("title").alias("titles"))
