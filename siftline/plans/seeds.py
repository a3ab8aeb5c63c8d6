"""Queries on brands, the seed set and feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup
from ..functions import urls as U
from ..operators import brands as B
from ..operators import features, seed
from .domains import HOST, TITLE, URL_FEATURES, sql_bare
from .registry import joined, plain, query, shared, table

BRANDS = [
    (0, "banks", "Theron Bank", ["theron.example.net", "pay.theron.example"], ["THB"], "banking"),
    (1, "portals", "Blog & Co", ["www.blog.example.com"], [], "media"),
    (2, "shops", "Shop", ["shop.example.org"], ["sh", "S.H.E"], "retail"),
    (3, "portals", "En", [], ["the"], "media"),
]
TOKENS = "(VALUES (0, 'Theron Bank', 'pay'), (0, 'Theron Bank', 'thb'), (0, 'Theron Bank', 'theron'), (0, 'Theron Bank', 'theronbank'), (1, 'Blog & Co', 'blog'), (1, 'Blog & Co', 'blogco'), (2, 'Shop', 'she'), (2, 'Shop', 'shop'), (3, 'En', 'the')) AS b(brand_no, brand, token)"


def _brands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BRANDS, "brand_no long, category string, name string, official_domains array<string>, aliases array<string>, sector string")


def _squash(x: str) -> str:
    return f"regexp_replace(lower({x}), '[^a-z0-9]', '', 'g')"


def _told(d: str, t: str) -> str:
    return f"CASE WHEN contains({_squash(d)}, token) THEN 'domain contains brand token ''' || token || '''' WHEN contains({_squash(t)}, token) THEN 'text contains brand token ''' || token || '''' END"


@query(f"""WITH {sql_bare('url', 'pages', 'page_id, html')}, x AS (SELECT page_id, d, {TITLE} AS title FROM bare),
m AS (SELECT page_id, brand_no, brand, {_told('d', 'title')} AS e FROM x CROSS JOIN {TOKENS})
SELECT page_id, brand, string_agg(e, '|' ORDER BY e) AS evidence FROM m WHERE e IS NOT NULL GROUP BY page_id, brand_no, brand""")
def brand_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    found = B.matches(B.catalog(_brands(spark)), U.bare_domain(F.col("url")), markup.title(F.col("html")))
    return p.select("page_id", F.explode(found).alias("m")).select("page_id", "m.brand", "m.evidence").withColumn("evidence", joined("evidence"))


BLACK = f"SELECT page_id AS line_no, {HOST} AS value FROM {{pages}} UNION ALL SELECT page_id + 500000, concat('http://plain', page_id, '.example/x') FROM {{pages}}"
WHITE = "SELECT doc_id AS line_no, concat('www.', source, '-', doc_id % 7, '.example') AS value FROM {documents} UNION ALL SELECT -1, ''"
CRAWLED = f"SELECT DISTINCT regexp_replace({HOST}, '^www[.]', '') AS domain FROM {{pages}} WHERE page_id % 3 = 0 UNION SELECT concat('plain', page_id, '.example') FROM {{pages}} WHERE page_id % 3 = 0"
_SEED = f"""w AS ({plain(BLACK)}), {sql_bare('value', 'w', 'line_no')},
bl AS (SELECT DISTINCT d FROM bare WHERE d <> ''), cr AS ({plain(CRAWLED)}),
ev AS (SELECT d, list_sort(list_distinct(list(e))) AS es FROM (SELECT d, {_told('d', "''")} AS e FROM bl CROSS JOIN {TOKENS}) WHERE e IS NOT NULL GROUP BY 1),
sc AS (SELECT d, coalesce(es, []) AS es, d IN (SELECT domain FROM cr) AS has FROM bl LEFT JOIN ev USING (d)),
rk AS (SELECT *, CASE WHEN length(es) > 0 AND has THEN 0 WHEN length(es) > 0 THEN 1 WHEN has THEN 2 ELSE 3 END AS score FROM sc),
bad AS (SELECT * FROM rk ORDER BY score, d LIMIT 40),
g AS (SELECT regexp_replace(value, '^www[.]', '') AS d, min(line_no) AS pos FROM ({plain(WHITE)}) WHERE value <> '' GROUP BY 1 ORDER BY pos LIMIT 25),
seeds AS (SELECT 'phish_' || substr(sha1('1:' || d), 1, 12) AS record_id, 'http://' || d AS url, d AS domain, 1 AS label, 'local_blacklist' AS source,
  array_to_string(list_sort(list_concat(['listed in local black.txt'], CASE WHEN has THEN ['local crawl has extracted text'] ELSE [] END, es)), '|') AS evidence FROM bad
 UNION ALL SELECT 'legit_' || substr(sha1('0:' || d), 1, 12), 'http://' || d, d, 0, 'brand_catalog_official_domains', 'official domain from brand catalog' FROM g)"""


def _seeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    crawled = shared(spark, sf_dir, CRAWLED)
    return seed.seed(shared(spark, sf_dir, BLACK), shared(spark, sf_dir, WHITE), _brands(spark), crawled, 40, 25, "black.txt"), crawled


@query(f"WITH {_SEED} SELECT record_id, url, domain, label::BIGINT AS label, source, evidence FROM seeds")
def seed_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seeds(spark, sf_dir)[0].select("record_id", "url", "domain", "label", "source", joined("evidence"))


@query(f"WITH {_SEED} SELECT count(*) AS records, count(*) FILTER (label = 1) AS phishing, count(*) FILTER (label = 0) AS legitimate, count(*) FILTER (label = 1 AND domain IN (SELECT domain FROM cr)) AS phishing_with_text FROM seeds")
def seed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed.seed_stats(*_seeds(spark, sf_dir))


@query(f"WITH {_SEED} SELECT d AS domain, has AS has_content, score::BIGINT AS score FROM rk")
def seed_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = seed.ranked(shared(spark, sf_dir, BLACK), shared(spark, sf_dir, CRAWLED), B.catalog(_brands(spark)))
    return own.select("domain", "has_content", "score")


#: The urls of documents: several for each domain, some of which have a brand's token.
DOC_URL = "concat('http://www.', CASE doc_id % 5 WHEN 0 THEN 'theronbank-' WHEN 1 THEN 'my-shop' ELSE 'd' END, CAST(doc_id % 700 AS STRING), '.', coalesce(lang, 'xx'), '.example/verify/', CAST(doc_id AS STRING))"
#: Page texts of two files: all documents, as they are.
TEXTS = f"""SELECT concat('f', CAST(doc_id % 2 AS STRING)) AS file, doc_id AS line_no, {DOC_URL} AS url, text, concat('Title ', source) AS title,
 CAST(NULL AS STRING) AS meta_description, CASE WHEN doc_id % 3 = 0 THEN CAST(2 AS INT) END AS forms_count, doc_id % 6 = 3 AS has_password_field, 'direct' AS method, lang AS fetched_at, n_chars FROM {{documents}}"""
#: A seed for each of them, and one for a domain without text.
SEEDS = f"SELECT doc_id AS page_id, {DOC_URL} AS url FROM {{documents}} UNION ALL SELECT -1, 'http://nothing.example/'"
_CONTENT = f"""x AS ({plain(TEXTS)}), {sql_bare('url', 'x', 'file, line_no, url, text, title, meta_description, forms_count, has_password_field, method, fetched_at')},
content AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY file, line_no) AS n FROM bare WHERE d <> '' AND text <> '') WHERE n = 1)"""


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = shared(spark, sf_dir, TEXTS)
    links = F.when(F.col("forms_count").isNotNull(), F.array(F.lit("http://a.example/"), F.col("url")))
    return seed.content_index(own.withColumns({"external_links": links, "links_to_domains": F.when(links.isNotNull(), F.array(F.lit("a.example")))}))


@query(f"WITH {_CONTENT} SELECT d AS domain, file, line_no, title, text FROM content")
def content_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir).select("domain", "file", "line_no", "title", "text")


_FEATURES = f"""{_CONTENT}, s0 AS (SELECT page_id, url AS v FROM ({plain(SEEDS)})), {sql_bare('v', 's0', 'page_id, v', 's_')},
s AS (SELECT {URL_FEATURES}, page_id AS pid FROM s_bare),
j AS (SELECT s.*, coalesce(c.text, '') AS text, c.title, c.file, c.forms_count, c.has_password_field, c.method, c.fetched_at FROM s LEFT JOIN content c ON s.domain = c.d)"""


@query(f"""WITH {_FEATURES}, m AS (SELECT pid, brand_no, brand, {_told('domain', "text || ' ' || coalesce(title, '')")} AS e FROM j CROSS JOIN {TOKENS}),
br AS (SELECT pid, string_agg(brand, '|' ORDER BY brand_no) AS brands, sum(k) AS n_evidence FROM (SELECT pid, brand_no, brand, count(*) AS k FROM m WHERE e IS NOT NULL GROUP BY ALL) GROUP BY 1)
SELECT j.page_id, url, domain, url_length, domain_length, subdomain_count, tld, suspicious_tokens, coalesce(brands, '') AS brands, coalesce(n_evidence, 0)::BIGINT AS n_evidence, length(text) AS text_length, text, file AS content_source_file, title,
coalesce(forms_count, 0)::BIGINT AS forms_count, coalesce(has_password_field, false) AS has_password_field, CASE WHEN forms_count IS NULL THEN 0 ELSE 2 END::BIGINT AS external_link_count, CASE WHEN forms_count IS NULL THEN '' ELSE 'a.example' END AS links_to_domains, method, fetched_at
FROM j LEFT JOIN br ON j.pid = br.pid""")
def features_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = shared(spark, sf_dir, SEEDS)
    seeds = p.select(F.col("page_id").cast("string").alias("record_id"), "url", U.bare_domain(F.col("url")).alias("domain"), F.lit(1).alias("label"), F.lit("s").alias("source"))
    rows = features.features(seeds, _content(spark, sf_dir), B.catalog(_brands(spark)))
    found = F.col("brand_matches")
    return rows.withColumns({
        "page_id": F.col("record_id").cast("long"), "suspicious_tokens": joined("suspicious_tokens"), "links_to_domains": joined("links_to_domains"),
        "brands": F.array_join(F.transform(found, lambda m: m["brand"]), "|"), "n_evidence": F.aggregate(found, F.lit(0), lambda n, m: n + F.size(m["evidence"])),
    }).drop("record_id", "brand_matches", "label", "source", "meta_description")


@query(f"WITH {_FEATURES} SELECT count(*) AS records, count(*) FILTER (text = '') AS missing_text FROM j")
def feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = shared(spark, sf_dir, SEEDS)
    seeds = p.select(F.lit("").alias("record_id"), "url", U.bare_domain(F.col("url")).alias("domain"), F.lit(1).alias("label"), F.lit("s").alias("source"))
    return features.feature_stats(features.features(seeds, _content(spark, sf_dir), B.catalog(_brands(spark))))
