"""The operators' queries, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, langid, linelog, neardup, ordinal, rules, substring, tokenfile, urlfilter
from .common import documents, labels

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.digests(documents(spark, sf_dir), tokenizers.path("byte_bpe_50k.json"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(documents(spark, sf_dir), percent=85, k=5)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = rules.judge(docs, rules.fit(docs, labels(spark, sf_dir)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = langid.predict(docs, langid.fit(docs))
    return out.select("doc_id", langid.held_out().alias("held_out"), "spoken.lang_pred", "spoken.score")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(documents(spark, sf_dir), k=13)


URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, by = spark.read.parquet(f"{sf_dir}/pages.parquet"), urlfilter.Rules(URL_RULES)
    return urlfilter.judge(pages, by, urlfilter.fit(pages, by, text="html")).drop("blocked")


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return ordinal.judge(docs, ordinal.fit(docs, labels(spark, sf_dir)))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that stays (null where the text is)."""
    out = linelog.clean(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}


WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, length(ws) - 4)) AS i FROM w WHERE length(ws) >= 5)
 UNION SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE length(ws) BETWEEN 1 AND 4),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 85 * (p.n + q.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY 1)
SELECT n.doc_id, n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN m ON n.doc_id = m.node"""

OP6 = f"""WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(generate_series(1, length(ws) - 12)) AS i FROM w WHERE length(ws) >= 13)),
m AS (SELECT s, min(doc_id) AS first FROM g GROUP BY 1),
h AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT g.doc_id, g.i, unnest(generate_series(0, 12)) AS k FROM g JOIN m ON g.s = m.s WHERE first < g.doc_id)),
v AS (SELECT w.doc_id, length(ws) AS n, unnest(generate_series(1, length(ws))) AS j, unnest(ws) AS word FROM w),
k AS (SELECT v.doc_id, sum(CASE WHEN h.j IS NULL THEN 0 ELSE 1 END)::BIGINT AS lost, string_agg(word, ' ' ORDER BY v.j) FILTER (h.j IS NULL) AS kept FROM v LEFT JOIN h ON v.doc_id = h.doc_id AND v.j = h.j GROUP BY 1)
SELECT w.doc_id, length(ws) AS n_words, coalesce(lost, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k ON w.doc_id = k.doc_id"""

OP9 = f"""WITH l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS line_no, unnest(ls) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)),
t AS (SELECT doc_id, line_no, {WORDS.format("regexp_replace(line, '[^ \\t-\\r]*[0-9][^ \\t-\\r]*', '<*>', 'g')")} AS ts FROM l),
k AS (SELECT doc_id, line_no, ts, length(ts) || ' ' || array_to_string(ts[1:4], ' ') AS leaf, array_to_string(ts, ' ') AS own FROM t WHERE length(ts) >= 5),
o AS (SELECT leaf, own, any_value(ts) AS ts, count(DISTINCT doc_id) AS docs FROM k GROUP BY 1, 2),
a AS (SELECT leaf, own, docs, generate_subscripts(ts, 1) AS pos, unnest(ts) AS token FROM o),
c AS (SELECT leaf, pos, token, sum(docs) AS held FROM a GROUP BY ALL),
b AS (SELECT a.leaf, a.own, a.pos, a.token, held FROM a JOIN c ON a.leaf = c.leaf AND a.pos = c.pos AND a.token = c.token),
v AS (SELECT leaf, own, list_sort(list(held), 'DESC')[ceil(0.6 * count(*))::INT] AS level FROM b GROUP BY 1, 2),
g AS (SELECT b.leaf, b.own, string_agg(CASE WHEN level < 3 OR held >= 0.9 * level THEN token ELSE '<*>' END, ' ' ORDER BY pos) AS key FROM b JOIN v ON b.leaf = v.leaf AND b.own = v.own GROUP BY 1, 2),
y AS (SELECT k.doc_id, k.line_no, k.leaf, g.key FROM k JOIN g ON k.leaf = g.leaf AND k.own = g.own),
r AS (SELECT leaf, key, min(doc_id) AS first FROM y GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT DISTINCT doc_id, line_no FROM y JOIN r ON y.leaf = r.leaf AND y.key = r.key WHERE doc_id > first),
z AS (SELECT l.doc_id, count(*) AS n_lines, count(d.line_no) AS n_dropped, string_agg(line, chr(10) ORDER BY l.line_no) FILTER (d.line_no IS NULL) AS kept FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.line_no = d.line_no GROUP BY 1)
SELECT q.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN q.text IS NULL THEN NULL ELSE sha256(coalesce(kept, '')) END AS kept_sha256 FROM documents q LEFT JOIN z ON q.doc_id = z.doc_id"""


def oracle_sql() -> dict[str, str]:
    """The models, tokenizers and alignments can't be told in SQL; tests hold those against brute force."""
    return {"op2_near_duplicates": OP2, "op6_substring_dedup": OP6, "op9_line_templates": OP9}
