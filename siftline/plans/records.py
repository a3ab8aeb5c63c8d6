"""Queries on feeds, dedup, limits and pages of lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import urls as U
from ..operators import relational
from ..sources import feeds
from .domains import HOST, VALID, sql_bare
from .registry import joined, plain, query, shared, table

#: A feed of each page: comments, blanks, comma lists, urls with commas, and lines without a domain.
FEED = f"""SELECT page_id, concat('# comment', chr(10), '! note', chr(10), '//x', chr(10), chr(10), page_id, ',', {HOST}, chr(10), url, ',y', chr(10), '  ', {HOST}, '  ', chr(13), chr(10),
 'nothing here', chr(10), 'a_b.example', chr(10), 'HTTP://', upper({HOST}), '/X') AS text FROM {{pages}}"""
LINES = f"""
f AS ({plain(FEED)}),
l AS (SELECT page_id, generate_subscripts(ls, 1) AS line_no, unnest(ls) AS v FROM (SELECT page_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) AS ls FROM f)),
m AS (SELECT page_id, line_no, trim(v) AS v FROM l WHERE trim(v) <> '' AND NOT regexp_matches(trim(v), '^(#|!|//)')),
x AS (SELECT page_id, line_no, CASE WHEN contains(v, ',') AND NOT regexp_matches(v, '^https?://') THEN trim(string_split(v, ',')[-1]) ELSE v END AS v FROM m),
{sql_bare('v', 'x', 'page_id, line_no, v')},
r AS (SELECT page_id, line_no, v AS raw_value, {VALID} AS domain FROM bare)"""


@query(f"WITH {LINES} SELECT page_id, line_no::BIGINT AS line_no, raw_value, domain, CASE WHEN contains(raw_value, '://') THEN raw_value ELSE 'http://' || raw_value END AS url, 'http://' || domain AS domain_url FROM r WHERE domain <> ''")
def feed_plain_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = feeds.plain_lines(shared(spark, sf_dir, FEED))
    names = feeds.plain_lines(shared(spark, sf_dir, FEED), domains_only=True).select("page_id", "line_no", F.col("url").alias("domain_url"))
    return own.join(names, ["page_id", "line_no"]).select("page_id", "line_no", "raw_value", "domain", "url", "domain_url")


RECORDS = f"SELECT page_id AS record_no, CASE WHEN page_id % 9 = 0 THEN ' bad url ' WHEN page_id % 10 = 0 THEN NULL ELSE concat(' ', url, ' ') END AS url, CAST(page_id AS STRING) AS phish_id, {HOST} AS target, '2024-01-01T00:00:00+00:00' AS submission_time, CAST(NULL AS STRING) AS verification_time FROM {{pages}}"


@query(f"WITH p AS ({plain(RECORDS)}), x AS (SELECT *, trim(coalesce(url, '')) AS v FROM p), {sql_bare('v', 'x', 'v, record_no, phish_id, target, submission_time, verification_time')} SELECT v AS url, domain, v AS raw_value, (record_no + 1)::BIGINT AS line_no, phish_id, target, submission_time, verification_time FROM (SELECT *, {VALID} AS domain FROM bare) WHERE domain <> ''")
def feed_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.csv_records(shared(spark, sf_dir, RECORDS))


RANKED = f"SELECT page_id + 1 AS line_no, CASE WHEN page_id % 4 = 0 THEN 'n/a' ELSE CAST(page_id + 1 AS STRING) END AS rank, CASE WHEN page_id % 7 = 0 THEN 'nodot' ELSE {HOST} END AS value FROM {{pages}}"


@query(f"WITH p AS ({plain(RANKED)}), {sql_bare('value', 'p', 'line_no, rank, value')} SELECT 'http://' || domain AS url, domain, value AS raw_value, line_no, CASE WHEN regexp_matches(rank, '^[0-9]+$') THEN rank::BIGINT END AS rank FROM (SELECT *, {VALID} AS domain FROM bare) WHERE domain <> ''")
def feed_ranked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.ranked_records(shared(spark, sf_dir, RANKED))


#: Records of three feeds, in order, with repeats between them.
SOURCES = f"SELECT 0 AS source_no, 'first' AS source, CAST(page_id % 3 - 1 AS INT) AS label, {HOST} AS domain, url, page_id AS line_no FROM {{pages}} UNION ALL SELECT 1, 'second', CAST(page_id % 2 AS INT), {HOST}, url, page_id FROM {{pages}} UNION ALL SELECT 2, 'third', CAST(1 AS INT), {HOST}, concat('http://', {HOST}), page_id FROM {{pages}}"


@query(f"SELECT source, label::BIGINT AS label, domain, url, line_no FROM (SELECT *, row_number() OVER (PARTITION BY label, domain, url ORDER BY source_no, line_no) AS n FROM ({plain(SOURCES)})) WHERE n = 1")
def dedup_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = shared(spark, sf_dir, SOURCES)
    return relational.first_wins(own, ["label", "domain", "url"], ["source_no", "line_no"]).drop("source_no")


@query(f"SELECT source, domain, line_no FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY line_no) AS n FROM ({plain(SOURCES)})) WHERE n <= 7")
def per_source_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.first_in_group(shared(spark, sf_dir, SOURCES), ["source"], ["line_no"], 7).select("source", "domain", "line_no")


@query("SELECT url, file, line_no, title FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY file, line_no) AS n FROM (SELECT url, 'b' AS file, page_id AS line_no, 'late' AS title FROM pages UNION ALL SELECT url, 'a', page_id + 5, CASE WHEN page_id % 2 = 0 THEN 'early' ELSE '' END FROM pages) WHERE title <> '') WHERE n = 1")
def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    late = p.select("url", F.lit("b").alias("file"), F.col("page_id").alias("line_no"), F.lit("late").alias("title"))
    early = p.select("url", F.lit("a").alias("file"), (F.col("page_id") + 5).alias("line_no"), F.when(F.col("page_id") % 2 == 0, "early").otherwise("").alias("title"))
    return relational.first_wins(late.union(early).where("title != ''"), ["url"], ["file", "line_no"])


#: List pages: three lists, with an unreachable page and one without items.
LIST_PAGES = f"""SELECT CAST(page_id % 3 AS STRING) AS list, CAST(page_id / 3 AS INT) + 1 AS page_no, CASE WHEN page_id % 11 = 5 THEN NULL WHEN page_id % 37 = 30 THEN '<p>none</p>' ELSE
 concat('<span class="a webkit-box-2 b"> www.', {HOST}, '/x </span><span class="c webkit-box-2">', chr(10), 'HTTP://', page_id, '.example </span><a href="?page=', page_id % 13, '">n</a><a href="?page=4">4</a>') END AS html FROM {{pages}}"""
LIST_PAGES = LIST_PAGES.replace("CAST(page_id / 3 AS INT)", "CAST((page_id - page_id % 3) / 3 AS INT)")
_ITEMS = "regexp_extract_all(html, '(?s)<span[^>]*class=\"[^\"]*webkit-box-2[^\"]*\"[^>]*>\\s*(.*?)\\s*</span>', 1)"


@query(f"""WITH p AS ({plain(LIST_PAGES)}), i AS (SELECT *, {_ITEMS} AS items FROM p), s AS (SELECT list, min(page_no) AS stop FROM i WHERE html IS NOT NULL AND length(items) = 0 AND page_no >= 2 GROUP BY 1),
k AS (SELECT i.list, page_no, unnest(items) AS item FROM i LEFT JOIN s ON i.list = s.list WHERE html IS NOT NULL AND (stop IS NULL OR page_no < stop))
SELECT list, page_no::BIGINT AS page_no, trim(split_part(regexp_replace(regexp_replace(lower(item), '^https?://', ''), '^www[.]', ''), '/', 1)) AS domain FROM k""")
def take_while_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared(spark, sf_dir, LIST_PAGES).withColumn("items", markup.scam_items(F.col("html")))
    kept = relational.take_while_filled(pages, ["list"], "page_no", F.col("html").isNotNull(), F.size("items") > 0)
    return kept.select("list", "page_no", F.explode("items").alias("domain"))


@query(f"WITH p AS ({plain(LIST_PAGES)}) SELECT list, max(coalesce(list_max(list_transform(regexp_extract_all(html, 'page=([0-9]+)', 1), lambda x: x::INTEGER)), 1))::BIGINT AS pages, least(max(coalesce(list_max(list_transform(regexp_extract_all(html, 'page=([0-9]+)', 1), lambda x: x::INTEGER)), 1)), 6)::BIGINT AS capped FROM p GROUP BY 1")
def page_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared(spark, sf_dir, LIST_PAGES)
    return pages.groupBy("list").agg(F.max(markup.page_count(F.col("html"))).alias("pages"), F.max(markup.page_count(F.col("html"), 6)).alias("capped"))


@query(f"""SELECT page_id, array_to_string(list_sort(list_distinct([{HOST}, 't' || page_id || '.example'])), '|') AS trusted,
array_to_string(list_sort(list_distinct([{HOST.replace('url', 'u')}, 'l' || page_id || '.example', 'u' || page_id || '.example', 'd' || page_id || '.example'])), '|') AS reported
FROM (SELECT page_id, url, regexp_replace(url, '://www[.]', '://') AS u FROM pages)""")
def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    host = U.page_host(F.col("url"))
    lit = F.lit
    trusted = F.concat(lit('<a class="x webkit-box-1" href="#"><span>  WWW.'), host, lit(' </span></a> <span class="webkit-box-1 y">t'), "page_id", lit(".example/p</span>"))
    reported = F.concat(lit('<span class="_urlText_1exle_106">http://'), host, lit('/q</span><a class="_urlLink_1exle_113" href="z"> l'), "page_id", lit('.example </a><script>{"url":"https://u'), "page_id", lit('.example/","x":1,"domain":"d'), "page_id", lit('.example"}</script>'))
    return p.select("page_id", markup.trusted_items(trusted).alias("trusted"), markup.report_items(reported).alias("reported")).withColumns({c: joined(c) for c in ("trusted", "reported")})


@query("SELECT doc_id, source, n_chars, (CASE WHEN lang = 'en' AND n_chars > 500 THEN 0 WHEN lang = 'en' THEN 1 WHEN n_chars > 500 THEN 2 ELSE 3 END)::BIGINT AS score FROM documents ORDER BY score, source, doc_id LIMIT 75")
def topk_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand, content = F.col("lang") == "en", F.col("n_chars") > 500
    score = F.when(brand & content, 0).when(brand, 1).when(content, 2).otherwise(3)
    return table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", score.alias("score")).orderBy("score", "source", "doc_id").limit(75)
