"""Queries on urls, domains and their lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.values import EXEMPT_WITH, EXEMPT_WITHOUT, GAMBLING_ADULT_PATTERNS, PLATFORM_ROOTS, SUSPICIOUS_TOKENS
from ..operators import features, lists, relational
from .registry import joined, plain, query, shared, table

HOST = "regexp_extract(url, '://([^/?#]*)', 1)"
#: Each url in several shapes: with user, port, dots, capitals, wildcards, markup, or nothing.
VARIANTS = f"""
SELECT page_id, k, CASE k
  WHEN 0 THEN url WHEN 1 THEN upper(url) WHEN 2 THEN concat('http://me:pw@', {HOST}, '/in') WHEN 3 THEN concat({HOST}, ':8080/x?y')
  WHEN 4 THEN concat('  .', {HOST}, '.  ') WHEN 5 THEN concat('www.', {HOST}) WHEN 6 THEN '' WHEN 7 THEN concat('a_b.', {HOST})
  WHEN 8 THEN concat({HOST}, '?q=http://else.example/') WHEN 9 THEN concat('*.', {HOST}, ':') WHEN 10 THEN concat('<svg xmlns=', {HOST}, '>')
  WHEN 11 THEN concat('ftp://www.', {HOST}, '#f') WHEN 12 THEN 'nodots' WHEN 13 THEN concat('bet', page_id % 7, '.', {HOST})
  WHEN 14 THEN 'github.io' WHEN 15 THEN concat('jtexpressextra', page_id % 3, '.example') WHEN 16 THEN concat('login-otp.', {HOST}, '/verify?bank=1')
  ELSE concat('x', page_id % 5, '.github.io/', k) END AS v
FROM {{pages}} CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7), (8), (9), (10), (11), (12), (13), (14), (15), (16), (17)) AS t(k)
"""
SCHEME = "^[a-z][a-z0-9+.-]*:"


def sql_bare(v: str, source: str, keep: str, p: str = "") -> str:
    """CTEs: source's column v to the bare domain d, in {p}bare; p goes before all their names."""
    return f"""
{p}a AS (SELECT {keep}, lower(trim({v})) AS v0 FROM {source}),
{p}b AS (SELECT {keep}, CASE WHEN contains(v0, '://') THEN v0 ELSE 'http://' || v0 END AS v1 FROM {p}a),
{p}c AS (SELECT {keep}, CASE WHEN regexp_matches(v1, '{SCHEME}//') THEN regexp_extract(v1, '{SCHEME}//([^/?#]*)', 1)
  ELSE regexp_extract(regexp_replace(v1, '{SCHEME}', ''), '^([^/?#]*)', 1) END AS h FROM {p}b),
{p}e AS (SELECT {keep}, split_part(string_split(h, '@')[-1], ':', 1) AS h FROM {p}c),
{p}bare AS (SELECT {keep}, regexp_replace(regexp_replace(regexp_replace(h, '^[.]+', ''), '[.]+$', ''), '^www[.]', '') AS d FROM {p}e)"""


#: The title of html, blanks collapsed and entities as characters.
TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
for _name, _char in (("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
    TITLE = f"replace({TITLE}, '&{_name};', '{_char}')"
TITLE = f"trim(regexp_replace(regexp_replace({TITLE}, '[\\r\\n]+', ' ', 'g'), ' {{2,}}', ' ', 'g'))"
VALID = "CASE WHEN regexp_matches(d, '^[a-z0-9.-]+$') AND contains(d, '.') THEN d ELSE '' END"


@query(f"WITH x AS ({plain(VARIANTS)}), {sql_bare('v', 'x', 'page_id, k')} SELECT page_id, k::BIGINT AS k, d AS bare, {VALID} AS domain FROM bare")
def normalize_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = shared(spark, sf_dir, VARIANTS)
    return v.select("page_id", "k", U.bare_domain(F.col("v")).alias("bare"), U.normalize_domain(F.col("v")).alias("domain"))


@query(f"""WITH x AS ({plain(VARIANTS)}) SELECT page_id, k::BIGINT AS k,
CASE WHEN trim(v) = '' OR contains(trim(v), '://') THEN trim(v) ELSE 'http://' || trim(v) END AS normal,
CASE WHEN contains(trim(v), '://') THEN trim(v) ELSE 'http://' || trim(v) END AS canonical FROM x""")
def normalize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, VARIANTS).select("page_id", "k", U.normalize_url(F.col("v")).alias("normal"), U.canonical_url(F.col("v")).alias("canonical"))


@query(f"""WITH x AS ({plain(VARIANTS)}) SELECT page_id, k::BIGINT AS k,
trim(split_part(regexp_replace(regexp_replace(lower(trim(v)), '^https?://', ''), '^www[.]', ''), '/', 1)) AS domain,
split_part(regexp_replace(lower(trim(v)), '^https?://', ''), '/', 1) AS fetch_key FROM x""")
def domain_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, VARIANTS).select("page_id", "k", U.domain_only(F.col("v")).alias("domain"), U.fetch_key(F.col("v")).alias("fetch_key"))


_EXEMPT = " AND ".join([*(f"contains(d, '{w}')" for w in EXEMPT_WITH), *(f"NOT contains(d, '{w}')" for w in EXEMPT_WITHOUT)])
CLEAN = f"""
p AS (SELECT page_id, k, lower(trim(v)) AS v FROM x),
q AS (SELECT page_id, k, CASE WHEN v = '' OR regexp_matches(v, '[<>]|xmlns=|fill=') THEN NULL ELSE
  trim(split_part(split_part(regexp_replace(regexp_replace(regexp_replace(v, '^https?://', ''), '^[*][.]', ''), '^[.]', ''), '/', 1), ':', 1)) END AS d FROM p),
r AS (SELECT page_id, k, CASE WHEN contains(d, '.') AND regexp_matches(d, '^[a-z0-9.-]+$') THEN d END AS white FROM q),
s AS (SELECT page_id, k, white, CASE WHEN d IN ({', '.join(f"'{x}'" for x in PLATFORM_ROOTS)})
  OR (regexp_matches(d, '{'|'.join(GAMBLING_ADULT_PATTERNS)}') AND NOT ({_EXEMPT})) THEN NULL ELSE d END AS black FROM (SELECT *, white AS d FROM r))"""


@query(f"WITH x AS ({plain(VARIANTS)}), {CLEAN} SELECT page_id, k::BIGINT AS k, black, white FROM s")
def clean_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = shared(spark, sf_dir, VARIANTS).select("page_id", "k", U.listed_domain(F.col("v")).alias("d"))
    return v.select("page_id", "k", *(F.when(U.allowed_domain(F.col("d"), b), F.col("d")).alias(n) for n, b in (("black", True), ("white", False))))


@query(f"WITH x AS ({plain(VARIANTS)}), {CLEAN} SELECT DISTINCT black AS domain FROM s WHERE black IS NOT NULL")
def clean_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.cleaned(shared(spark, sf_dir, VARIANTS), value="v")


@query(f"""WITH x AS ({plain(VARIANTS)}), {CLEAN} SELECT count(*) AS original, count(*) - count(black) AS ignored,
count(black) - count(DISTINCT black) AS merged, count(DISTINCT black) AS remaining FROM s""")
def list_clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lists.clean_stats(shared(spark, sf_dir, VARIANTS), value="v")


@query(f"WITH x AS ({plain(VARIANTS)}), {CLEAN} SELECT white AS domain, count(*) AS n FROM s WHERE white IS NOT NULL AND white NOT IN ({', '.join(f"'{x}'" for x in PLATFORM_ROOTS)}) GROUP BY 1")
def platform_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = spark.createDataFrame([(x,) for x in PLATFORM_ROOTS], "domain string")
    own = shared(spark, sf_dir, VARIANTS).select(U.clean_domain(F.col("v"), False).alias("domain")).where("domain IS NOT NULL")
    return own.join(F.broadcast(roots), "domain", "left_anti").groupBy("domain").agg(F.count(F.lit(1)).alias("n"))


_TOKENS = ", ".join(f"'{t}'" for t in sorted(SUSPICIOUS_TOKENS))
URL_FEATURES = f"""page_id, v AS url, d AS domain, length(v) AS url_length, length(d) AS domain_length, greatest(length(string_split(d, '.')) - 2, 0) AS subdomain_count,
CASE WHEN contains(d, '.') THEN string_split(d, '.')[-1] ELSE '' END AS tld, array_to_string(list_filter([{_TOKENS}], lambda t: contains(lower(d || ' ' || v), t)), '|') AS suspicious_tokens"""


@query(f"WITH x AS ({plain(VARIANTS)}), {sql_bare('v', 'x', 'page_id, k, v')} SELECT k::BIGINT AS k, {URL_FEATURES} FROM bare WHERE d <> ''")
def url_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = shared(spark, sf_dir, VARIANTS).withColumn("domain", U.bare_domain(F.col("v"))).where("domain != ''")
    return v.select("page_id", "k", F.col("v").alias("url"), "domain", *(c.alias(n) for n, c in features.url_features(F.col("domain"), F.col("v")).items())).withColumn("suspicious_tokens", joined("suspicious_tokens"))


_LABEL = "(page_id % 3 - 1)::INTEGER"
RECORD_ID = "CASE label WHEN 1 THEN 'phish' WHEN 0 THEN 'legit' ELSE 'unknown' END || '_' || substr(sha1(label::VARCHAR || ':' || d), 1, 12)"


@query(f"WITH {sql_bare('url', 'pages', 'page_id, url')} SELECT page_id, d AS domain, {RECORD_ID} AS record_id FROM (SELECT *, {_LABEL} AS label FROM bare)")
def record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("domain", U.bare_domain(F.col("url")))
    return pages.select("page_id", "domain", U.record_id((F.col("page_id") % 3 - 1).cast("int"), F.col("domain")).alias("record_id"))


@query(f"""WITH {sql_bare('url', 'pages', 'page_id, url, html')},
f AS (SELECT page_id, url AS v, d, html FROM bare)
SELECT {RECORD_ID.replace('label', '(-1)')} AS record_id, {URL_FEATURES},
{TITLE} AS title,
length(html) AS html_length, length(regexp_extract_all(html, '(?i)<form\\b')) AS forms_count FROM f""")
def page_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: a feature row for each page, in one pass without a shuffle."""
    from ..functions import markup

    p = table(spark, sf_dir, "pages").withColumn("domain", U.bare_domain(F.col("url")))
    own = features.url_features(F.col("domain"), F.col("url"))
    return p.select(
        U.record_id(F.lit(-1), F.col("domain")).alias("record_id"), "page_id", "url", "domain", *(c.alias(n) for n, c in own.items()),
        markup.title(F.col("html")).alias("title"), F.length("html").alias("html_length"), markup.forms_count(F.col("html")).alias("forms_count"),
    ).withColumn("suspicious_tokens", joined("suspicious_tokens"))


# Lists with labels: each url's domain, and some of another label again.
LABELLED = f"SELECT {HOST} AS domain, CAST(page_id % 3 - 1 AS INT) AS label, page_id FROM {{pages}} UNION ALL SELECT {HOST}, CAST(1 AS INT), page_id + 1000000 FROM {{pages}} WHERE page_id % 4 = 0"
OLD = f"SELECT DISTINCT concat('old-', page_id % 9, '.example') AS domain FROM {{pages}} UNION SELECT {HOST} FROM {{pages}} WHERE page_id % 5 = 0"


@query(f"WITH l AS ({plain(LABELLED)}), o AS ({plain(OLD)}) SELECT domain FROM o UNION SELECT domain FROM l WHERE label = 1")
def merge_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relational.merged(shared(spark, sf_dir, OLD), relational.route(shared(spark, sf_dir, LABELLED), 1))


@query(f"""WITH l AS ({plain(LABELLED)}), o AS ({plain(OLD)}), m AS (SELECT label, count(*) AS after FROM (SELECT 1 AS label, domain FROM o UNION SELECT 0, domain FROM o UNION SELECT label, domain FROM l WHERE label >= 0) GROUP BY 1)
SELECT label::BIGINT AS label, (SELECT count(*) FROM o) AS before, after, after - (SELECT count(*) FROM o) AS added FROM m""")
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = shared(spark, sf_dir, OLD), shared(spark, sf_dir, LABELLED)
    each = [relational.merge_stats(old, relational.route(new, label)).select(F.lit(label).alias("label"), "before", "after", "added") for label in (1, 0)]
    return relational.union_all(each)


@query(f"""WITH l AS ({plain(LABELLED)}), a AS (SELECT domain, page_id AS pos FROM l WHERE label = 0), b AS (SELECT 'official-' || page_id || '.example' AS domain, 10000000 + page_id AS pos FROM pages)
SELECT 'short' AS what, domain, pos FROM a UNION ALL SELECT 'full', domain, pos FROM a UNION ALL SELECT 'short', domain, pos FROM b WHERE (SELECT count(*) FROM a WHERE domain <> '') < 1000000 UNION ALL SELECT 'full', domain, pos FROM b WHERE (SELECT count(*) FROM a WHERE domain <> '') < 5""")
def conditional_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = shared(spark, sf_dir, LABELLED).where("label = 0").select("domain", F.col("page_id").alias("pos"))
    more = table(spark, sf_dir, "pages").select(F.concat(F.lit("official-"), "page_id", F.lit(".example")).alias("domain"), (10000000 + F.col("page_id")).alias("pos"))
    valid = F.col("domain") != ""
    each = [relational.append_if_short(own, more, valid, n).select(F.lit(what).alias("what"), "domain", "pos") for what, n in (("short", 1_000_000), ("full", 5))]
    return relational.union_all(each)


@query(f"WITH l AS ({plain(LABELLED)}) SELECT label::BIGINT AS label, domain, min(page_id) AS pos FROM l GROUP BY ALL")
def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = shared(spark, sf_dir, LABELLED).withColumn("key", F.struct("label", "domain"))
    return relational.ordered_distinct(own, "key", "page_id").select("key.*", F.col("page_id").alias("pos"))


@query(f"WITH l AS ({plain(LABELLED)}) SELECT label::BIGINT AS label, count(*) AS n FROM l GROUP BY 1")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, LABELLED).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


PROBES = "SELECT event_id, user_id % 5 > 0 AS dns_ok, CASE event_id % 6 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 WHEN 3 THEN 503 WHEN 4 THEN 0 END AS http_status FROM {events}"


@query(f"SELECT class, count(*) AS n FROM (SELECT CASE WHEN NOT dns_ok THEN 'dead_dns' WHEN http_status > 0 AND http_status < 400 THEN 'alive' ELSE 'dead_http' END AS class FROM ({plain(PROBES)})) GROUP BY 1")
def liveness_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.fetching import liveness

    return shared(spark, sf_dir, PROBES).groupBy(liveness(F.col("dns_ok"), F.col("http_status")).alias("class")).agg(F.count(F.lit(1)).alias("n"))
