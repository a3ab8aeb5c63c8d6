"""Queries on page html and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import charsets, html, markup
from ..functions import strings as S
from ..functions import urls as U
from ..functions.values import NOISE_PATTERNS
from ..operators import cleaning, extraction, fetching
from .domains import HOST, TITLE
from .registry import joined, plain, query, shared, table

NOISE = "|".join(f"(?:{p})" for p in NOISE_PATTERNS).replace("\\s", "[ \\t\\n\\r\\f]").replace("\\d", "[0-9]")

#: Document lines with some noise among them.
DOC_LINES = "SELECT doc_id, concat(text, chr(10), ' © 2024 Someone ', chr(10), 'Cookie policy text', chr(10), 'ab', chr(10), '12345 a', chr(10), 'Đã xem: 5', chr(10), chr(10), ' tail of it ') AS text FROM {documents}"
_L = f"l AS (SELECT doc_id, text, generate_subscripts(x, 1) AS line_no, trim(unnest(x)) AS v FROM (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM ({plain(DOC_LINES)})))"
_IS_NOISE = f"(regexp_matches(v, '(?i){NOISE}') OR length(v) < 3 OR length(regexp_replace(v, '\\P{{L}}', '', 'g')) / greatest(length(v), 1)::DOUBLE < 0.3)"


@query(f"WITH {_L} SELECT doc_id, line_no, v AS line FROM l WHERE v <> '' AND {_IS_NOISE}")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = shared(spark, sf_dir, DOC_LINES).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "v"))
    own = own.select("doc_id", (F.col("pos") + 1).alias("line_no"), S.strip(F.col("v")).alias("line"))
    return own.where((F.col("line") != "") & S.is_noise(F.col("line")))


@query(f"WITH {_L} SELECT d.doc_id, coalesce(string_agg(v, chr(10) ORDER BY line_no), '') AS text FROM documents d LEFT JOIN (SELECT * FROM l WHERE v <> '' AND NOT {_IS_NOISE}) k ON d.doc_id = k.doc_id GROUP BY 1")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, DOC_LINES).select("doc_id", S.clean_text(F.col("text")).alias("text"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace('  ' || text || chr(10), '[\\r\\n]+', ' ', 'g'), ' {2,}', ' ', 'g')) AS text, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS squashed FROM documents")
def collapse_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("  "), "text", F.lit("\n"))
    return table(spark, sf_dir, "documents").select("doc_id", S.collapse_whitespace(text).alias("text"), S.squash(F.col("text")).alias("squashed"))


#: Whole texts, a third of them dense with accents.
ACCENTED = "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN translate(text, 'aeiou', 'ãẽĩõũ') ELSE text END AS text FROM {documents}"


@query(f"""WITH a AS (SELECT doc_id, text, strlen(text) AS bytes, strlen(text) - length(regexp_replace(text, '[^\\x00-\\x7f]', '', 'g')) AS high FROM ({plain(ACCENTED)})),
b AS (SELECT *, bytes >= 10 AND high > 0.3 * bytes AS suspect FROM a)
SELECT doc_id, suspect, CASE WHEN suspect THEN length(text) ELSE bytes END AS n_chars, text FROM b""")
def fix_mojibake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read as Latin-1 by mistake: those dense with accents come back, others never change, which shows in their
    number of characters and in the text that they still are when read right."""
    wrong = F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1")
    own = shared(spark, sf_dir, ACCENTED).select("doc_id", S.looks_mojibake(wrong, 10).alias("suspect"), S.fix_mojibake(wrong).alias("fixed"))
    still = F.decode(F.encode(F.when(~F.col("suspect"), F.col("fixed")), "ISO-8859-1"), "UTF-8")
    return own.select("doc_id", "suspect", F.length("fixed").alias("n_chars"), F.when(F.col("suspect"), F.col("fixed")).otherwise(still).alias("text"))


@query("SELECT doc_id, lang, text FROM documents")
def decode_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in UTF-8, or in a declared one-byte charset that can hold the text: both decode to the text."""
    text = F.col("text")
    narrow = (F.col("doc_id") % 2 == 0) & ~text.rlike("[^\\x{0}-\\x{7f}\\x{a0}-\\x{ff}]")
    raw = F.when(narrow, F.encode(F.when(narrow, text), "ISO-8859-1")).otherwise(F.encode(text, "UTF-8"))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", charsets.decode(raw, F.when(narrow, "iso-8859-1")).alias("text"))


#: Pages with forms, links, hidden parts and metas added to some.
TAGGED = f"""SELECT page_id, url, concat(CASE page_id % 5 WHEN 0 THEN '<form action="/in"><input type="password"></form>' WHEN 1 THEN concat('<a href="https://www.x', page_id, '.example/a?b">x</a><a href=" http://Y.example ">y</a><a href="/own">o</a><a href="mailto:a@b.c">m</a><a href="http://', {HOST}, '/z">z</a>')
 WHEN 2 THEN '<FORM><input type="text"></FORM><input type="password">' WHEN 3 THEN '<meta name="description" content=" Some page ">' ELSE '<p>plain</p>' END, html) AS html FROM {{pages}}"""
# What stands between tags, for pages whose dropped elements are closed.
_DROP = "script|style|nav|footer|header|aside|noscript|iframe|svg|canvas|button|select|option|textarea"
_BLOCKS = " ".join(f"<{t}[^>]*>.*?</{t}>|" for t in _DROP.split("|")).replace(" ", "")
_TEXT = "replace(replace(replace(replace(replace(replace(t, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
VISIBLE = f"""
s AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?is){_BLOCKS}<!--.*?-->', chr(1), 'g'), '(?s)<[^>]*>', chr(1), 'g') AS t FROM pages),
n AS (SELECT page_id, list_filter(list_transform(string_split({_TEXT}, chr(1)), lambda x: regexp_replace(regexp_replace(x, '^[ \\t\\r\\n]+', ''), '[ \\t\\r\\n]+$', '')), lambda x: x <> '') AS nodes FROM s)"""


@query(f"WITH {VISIBLE} SELECT n.page_id, array_to_string(nodes, chr(10)) AS text, length(list_filter(regexp_split_to_array(array_to_string(nodes, ' '), '[ \\t\\r\\n]+'), lambda w: w <> '')) AS words FROM n")
def visible_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL tells it for pages whose dropped elements are closed, as those of the tables are; tests hold others."""
    return table(spark, sf_dir, "pages").select("page_id", html.parsed("html").alias("x")).select("page_id", "x.text", "x.words")


@query(f"""SELECT page_id, {TITLE} AS title, CASE WHEN page_id % 5 = 3 THEN 'Some page' END AS meta_description,
length(regexp_extract_all(html, '(?i)<form\\b')) AS forms_count, page_id % 5 = 0 AS has_password_field,
CASE WHEN page_id % 5 = 1 THEN 'https://www.x' || page_id || '.example/a?b|http://Y.example|http://' || {HOST} || '/z' ELSE '' END AS external_links,
CASE WHEN page_id % 5 = 1 THEN array_to_string(list_sort(['x' || page_id || '.example', 'y.example']), '|') ELSE '' END AS links_to_domains FROM ({plain(TAGGED)})""")
def extract_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = extraction.extracted(shared(spark, sf_dir, TAGGED).withColumns({c: F.lit(None).cast("string") for c in ("source", "method", "fetched_at")}).withColumn("source", F.col("page_id").cast("string")))
    return own.select(F.col("source").cast("long").alias("page_id"), "title", "meta_description", "forms_count", "has_password_field", joined("external_links"), joined("links_to_domains"))


@query(f"SELECT page_id, length(regexp_extract_all(html, '(?i)<form\\b')) AS forms, regexp_matches(html, '(?i)<form\\b|type=[\"'']?password') AS signal FROM ({plain(TAGGED)})")
def form_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = shared(spark, sf_dir, TAGGED)
    return p.select("page_id", markup.forms_count(F.col("html")).alias("forms"), S.has_form_signal(F.col("html")).alias("signal"))


@query(f"""WITH h AS (SELECT page_id, url, list_filter(list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: trim(x)), lambda x: regexp_matches(x, '^https?://')) AS links FROM ({plain(TAGGED)})),
d AS (SELECT page_id, length(links) AS n_links, list_filter(list_transform(links, lambda x: lower(regexp_extract(x, '://([^/?#]*)', 1))), lambda x: x <> '' AND x <> {HOST}) AS hosts FROM h)
SELECT page_id, n_links, array_to_string(list_sort(list_distinct(list_transform(hosts, lambda x: regexp_replace(x, '^www[.]', '')))), '|') AS domains FROM d""")
def link_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = F.transform(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)), S.strip)
    p = shared(spark, sf_dir, TAGGED).withColumn("links", U.absolute_links(hrefs))
    return p.select("page_id", F.size("links").alias("n_links"), U.link_domains(F.col("links"), F.col("url")).alias("domains")).withColumn("domains", joined("domains"))


#: Crawled files: missing, empty, repeated, oversized and parked pages among others.
CRAWLED = """SELECT concat('f', page_id % 2) AS file, page_id AS line_no, page_id % 29 = 28 AS malformed, CASE WHEN page_id % 10 = 9 THEN concat(' ', upper(url)) ELSE url END AS url,
 CASE page_id % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat('<p>Buy  this domain</p>', html) WHEN 3 THEN concat(html, repeat('<!-- filler filler filler -->', CASE WHEN page_id % 64 = 3 THEN 400000 ELSE 0 END)) ELSE html END AS html FROM {pages}
 UNION ALL SELECT concat('f', page_id % 2), page_id + 1000000, false, url, html FROM {pages} WHERE page_id % 3 = 0"""
_WORDS = f"""w AS (SELECT file, line_no, length(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(html, '(?is){_BLOCKS}<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+'), lambda x: x <> '')) AS words FROM c WHERE html IS NOT NULL AND strlen(html) <= 10485760)"""
_REASONED = f"""c AS ({plain(CRAWLED)}),
k AS (SELECT *, lower(trim(coalesce(url, ''))) AS url_key, malformed OR html IS NULL OR html = '' AS empty FROM c),
f1 AS (SELECT file, line_no FROM (SELECT file, line_no, row_number() OVER (PARTITION BY file, url_key ORDER BY line_no) AS n FROM k WHERE NOT empty) WHERE n = 1),
{_WORDS},
r AS (SELECT k.file, k.line_no, k.url_key, CASE WHEN empty THEN 'failed_html' WHEN f1.line_no IS NULL THEN 'duplicate_url' WHEN strlen(html) > 10485760 THEN 'too_large'
 WHEN regexp_matches(lower(substr(html, 1, 5000)), 'buy\\s+this\\s+domain') THEN 'parking_page' WHEN words < 200 THEN 'too_short' ELSE 'kept' END AS reason
 FROM k LEFT JOIN f1 USING (file, line_no) LEFT JOIN w USING (file, line_no))"""


def _reasoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.with_reason(shared(spark, sf_dir, CRAWLED), 200, malformed="malformed")


@query(f"WITH {_REASONED} SELECT file, line_no, url_key, reason FROM r")
def clean_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasoned(spark, sf_dir).select("file", "line_no", "url_key", "reason")


_COUNTS = ", ".join(f"count(*) FILTER (reason = '{x}') AS {x}" for x in cleaning.REASONS)


@query(f"WITH {_REASONED} SELECT file, count(*) AS total, {_COUNTS}, 200::BIGINT AS min_words FROM r GROUP BY 1")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_stats(_reasoned(spark, sf_dir))


@query(f"WITH {_REASONED} SELECT count(DISTINCT file) AS files, count(*) AS total, {_COUNTS}, round(100.0 * count(*) FILTER (reason = 'kept') / count(*), 1)::DOUBLE AS kept_percent FROM r")
def grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.grand_total(cleaning.clean_stats(_reasoned(spark, sf_dir)))


@query(f"WITH c AS ({plain(CRAWLED)}) SELECT count(*) FILTER (NOT malformed) AS processed, count(*) FILTER (malformed OR html IS NULL OR html = '') AS errors, 0::BIGINT AS mojibake_fixed FROM c")
def extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_stats(shared(spark, sf_dir, CRAWLED), malformed="malformed")


# Answers of resolvers, sites and an archive for each page's own name.
_NAME = "concat('d', page_id, '.example')"
NAMES = f"SELECT {_NAME} AS domain FROM {{pages}} UNION ALL SELECT ''"
DNS = f"SELECT {_NAME} AS domain, r AS resolver, page_id % 6 <> 0 AND page_id % 2 = r AS ok FROM {{pages}} CROSS JOIN (VALUES (0), (1)) AS t(r)"
SITE = f"""SELECT {_NAME} AS domain, scheme, attempt, CASE WHEN page_id % 7 = 0 THEN CASE WHEN scheme = 'http' THEN 200 END WHEN page_id % 7 = 1 THEN CASE WHEN attempt = 0 THEN 503 ELSE 200 END WHEN page_id % 7 = 2 THEN 404
 WHEN page_id % 7 = 3 AND scheme = 'https' THEN 500 ELSE 200 END AS status_code, CASE WHEN page_id % 9 = 4 THEN 'few words' WHEN page_id % 9 = 5 THEN '<form>few</form>' WHEN page_id % 9 = 6 THEN '' ELSE repeat('many words in ', 30) END AS body
 FROM {{pages}} CROSS JOIN (VALUES ('https', 0), ('https', 1), ('http', 0), ('http', 1)) AS t(scheme, attempt)"""
ARCHIVE = f"SELECT {_NAME} AS domain, CASE WHEN page_id % 4 = 1 THEN '404' ELSE '200' END AS closest_status, CASE WHEN page_id % 4 = 2 THEN '' ELSE repeat('old words here ', 20) END AS body FROM {{pages}} WHERE page_id % 2 = 0"
_FETCHED = f"""s AS ({plain(SITE)}),
u AS (SELECT s.*, CASE WHEN scheme = 'https' THEN 0 ELSE 2 END + attempt AS rank FROM s WHERE status_code IS NOT NULL AND (attempt = 0 OR EXISTS (SELECT 1 FROM s z WHERE z.domain = s.domain AND z.scheme = s.scheme AND z.attempt = 0 AND z.status_code IN (429, 503)))),
d AS (SELECT domain, arg_min(body, rank) FILTER (status_code < 400) AS html, coalesce(arg_min(status_code, rank) FILTER (status_code < 400), arg_max(status_code, rank)) AS status_code FROM u WHERE domain IN (SELECT domain FROM ({plain(DNS)}) WHERE ok) GROUP BY 1),
g AS (SELECT n.domain, coalesce(d.html, a.body) AS html, CASE WHEN d.html IS NOT NULL THEN 'direct' WHEN a.body IS NOT NULL THEN 'wayback' END AS method, CASE WHEN d.html IS NULL AND a.body IS NOT NULL THEN 200 ELSE d.status_code END AS status_code
 FROM ({plain(NAMES)}) n LEFT JOIN d USING (domain) LEFT JOIN (SELECT * FROM ({plain(ARCHIVE)}) WHERE closest_status = '200' AND body <> '') a USING (domain) WHERE n.domain <> ''),
h AS (SELECT *, length(list_filter(string_split(regexp_replace(html, '<[^>]*>', ' ', 'g'), ' '), lambda x: x <> '')) AS words FROM g),
o AS (SELECT domain AS url, CASE WHEN html IS NULL THEN 'DNS fail + no Wayback snapshot' WHEN words < 50 AND NOT regexp_matches(html, '<form') THEN 'HTML content too short (' || words || ' words, minimum required is 50)' END AS error, html, method, status_code::BIGINT AS status_code FROM h
 UNION ALL SELECT '', 'empty domain', NULL, NULL, NULL),
p AS (SELECT url, CASE WHEN error IS NULL THEN html END AS html, CASE WHEN error = 'empty domain' THEN NULL WHEN error IS NOT NULL THEN 'failed' ELSE method END AS method, status_code, error FROM o)"""


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetching.outcomes(*(shared(spark, sf_dir, x) for x in (NAMES, DNS, SITE, ARCHIVE)))


@query(f"WITH {_FETCHED} SELECT url, html, method, status_code, error FROM p")
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir)


@query(f"WITH {_FETCHED} SELECT count(*) AS total, count(html) AS success, count(*) - count(html) AS failed FROM p")
def fetch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetching.fetch_stats(_fetched(spark, sf_dir))
