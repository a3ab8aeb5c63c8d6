"""Language ID, url filter, ordinal quality and learned rules: odd rows, brute force for what is exact, held-out accuracy for models."""

import collections
import functools
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftline.llm import langid, ordinal, registry, rules, urlfilter

from .test_native import WORD, brute_counts

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")

DOCS = "doc_id long, text string, lang string, spoken string"


def speech(rng, lang, n):
    letters = {"xx": "abcdefg", "yy": "hijklmn", "zz": "émñópqr"}[lang]
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(n))


def test_language(spark):
    rng = random.Random(1)
    rows = [(i, speech(rng, lang, rng.randrange(3, 80)), lang, "x") for i, lang in enumerate(["xx", "yy", "zz"] * 80)]
    odd = [(1000, None, "xx", "x"), (1001, "", "xx", "x"), (1002, "12 + 3 ... 😀", None, "x"), (None, "abc abc", "xx", "x"), (1003, speech(rng, "yy", 200_000), None, "x"), (5, "héhé", None, "x"), (5, "hihi", None, "x")]
    df = spark.createDataFrame(rows + odd, DOCS)
    net = langid.fit(df, sample=400)
    got = langid.predict(df, net, "told").select("*", "told.*", langid.held_out().alias("held")).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.spoken == "x" for r in got)
    own = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.lang]
    held = [r.lang == r.lang_pred for r in own if r.held]
    assert len(held) > 40 and np.mean(held) > 0.95
    by = {r.doc_id: r.lang_pred for r in got}
    assert [by[i] for i in (1000, 1001, 1002)] == ["und"] * 3 and by[1003] == "yy"


def test_language_without_rows(spark):
    df = spark.createDataFrame([], DOCS)
    assert langid.fit(df) is None and langid.predict(df, None).collect() == []
    one = spark.createDataFrame([(1, "text", None, None)], DOCS)
    assert langid.predict(one, langid.fit(one)).select("spoken.*").first() == ("und", 0.0)


def test_network_gradients():
    rng = np.random.default_rng(2)
    net = langid.Net(["a", "b"], widths=(2, 3), size=3, filters=4)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.fold()
    x, y, w = rng.integers(0, 256, (5, 12)).astype(np.uint8), np.array([0, 1, 1, 0, 1]), np.ones(5)

    def loss():
        net.fold()
        p = net.probabilities(x).astype(float)
        return -np.log(p[np.arange(5), y]).mean() + 0.5e-4 * (net.p["v"] ** 2).sum()

    for k, g in net.gradients(x, y, w).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        held = net.p[k][i]
        net.p[k][i] = held + 1e-3
        up = loss()
        net.p[k][i] = held - 1e-3
        down = loss()
        net.p[k][i] = held
        assert abs((up - down) / 2e-3 - g[i]) < 2e-3 + 0.02 * abs(g[i]), k


def brute_rule(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[2:] if fits else (None, None))


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/7x?q#f", "http://example.com/en/", "http://xcom/en/", "http://com/en/", "https://u.net/de/8", "http://example.net/de/8/", "http://b.org?/es/", "http://b.org/es/#x", "ftp://o://p.org/es/", "http://É.com/en/\n2", "http://" + "a." * 300 + "com/en/1"]


def test_url_rules(spark):
    by = urlfilter.Rules(registry.URL_RULES)
    hosts = [f"{a}.{b}" for a in ("www", "a", "shop") for b in ("example.com", "x.com", "example.net", "y.net", "z.org", "z.io")]
    urls = URLS + [f"http://{h}/{p}" for h in hosts for p in ("en/", "en/7", "de/", "de/8", "es/x", "fr/")]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)] + [(None, "http://a.com/en/", None, None)], "page_id long, url string, html string, verdict string")
    got = urlfilter.judge(df, by, urlfilter.fit(df, by)).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        if r.page_id is not None:
            host, path, rule, verdict = brute_rule(urls[r.page_id], registry.URL_RULES)
            assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict), urls[r.page_id]
            assert r.verdict in ("allow", "block")
    assert {r.verdict for r in got if r.host == ""} == {"allow"}
    none = df.limit(0)
    assert urlfilter.judge(none, by, urlfilter.fit(none, by)).collect() == []


def test_segmentation_and_bayes():
    model = urlfilter.Model({"free": 50.0, "casino": 50.0, "town": 50.0, "library": 50.0, "win": 9.0}, {"free": (9.0, 0.0), "casino": (9.0, 0.0), "town": (0.0, 9.0), "library": (0.0, 9.0)})
    assert model.segment("freecasino") == ("free", "casino") and model.segment("townlibrary") == ("town", "library") and model.segment("x1") == ("x1",)
    assert model.segment("winter") == ("winter",)  # not win and a rest
    assert model.blocked(["freecasino"]) > 0.9 > 0.1 > model.blocked(["townlibrary"]) and model.blocked([]) == model.blocked(["unseen"]) == 0.5
    assert model.blocked(["freecasino88"]) > 0.9 and model.blocked(["free4casino"]) > 0.9
    assert model.segment("freecasino" * 30_000) == ("free", "casino") * 30_000


LEARNED = [("bad.com", "", "block"), ("ill.net", "", "block"), ("good.com", "", "allow"), ("fine.net", "", "allow")]


def learned_urls(rng):
    """Pages that rules decide, whose hosts are put together from two words; and other hosts of the same words."""
    of = {"block": "cheap pills casino bonus poker torrent".split(), "allow": "town library museum garden school choir".split()}
    names = {v: [a + b for a in w for b in w if a != b] for v, w in of.items()}
    for own in names.values():
        rng.shuffle(own)
    rows = []
    for v, hosts in (("block", ["bad.com", "ill.net"]), ("allow", ["good.com", "fine.net"])):
        rows += [(f"http://{rng.choice(names[v][:20])}.{rng.choice(hosts)}/{rng.choice('abc')}/{rng.randrange(99)}", " ".join(rng.sample(sum(of.values(), []), 6))) for _ in range(300)]
        rows += [(f"http://{name}.elsewhere.org/", f"<p>{v}</p>") for name in names[v][20:]]
    return rows, {f"{name}.elsewhere.org": v for v, own in names.items() for name in own[20:]}


def test_unseen_names_are_judged_by_their_words(spark):
    rows, want = learned_urls(random.Random(1))
    hot = [("http://cheappills.hot.info/", None)] * 500  # its own count can't vouch for it
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows + hot)], "page_id long, url string, html string")
    by = urlfilter.Rules(LEARNED)
    model = urlfilter.fit(df, by, text="html")
    assert model.segment("cheappills") == ("cheap", "pills")
    got = {r.host: r.verdict for r in urlfilter.judge(df, by, model).collect()}
    assert {h: got[h] for h in want} == want and got["cheappills.hot.info"] == "block"


def brute_model(pages, rules, share=1 / 250_000, least=20):
    """The url model by its definition, in plain Python: (words, total, seen, sums)."""
    named = {w for h, p, _ in rules for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", f"{h}/{p}".lower()) if w}
    cut = lambda x: ["0" if w.isdigit() else w for w in re.split(r"[^a-z0-9\x80-\U0010ffff]+", x.lower()) if w]
    stands, seen = collections.Counter(), {"block": collections.Counter(), "allow": collections.Counter()}
    judged = []
    for url, html in pages:
        host, path, _, verdict = brute_rule(url, rules)
        tokens = [t for t in cut(f"{host}/{path}") if t not in named]
        judged.append((tokens, verdict))
        for w in set(cut(path)).union(*(cut(x) for x in host.split(".") if len(cut(x)) > 1)):
            stands[w] += len(w) > 1 and w.isalpha() and w not in named
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ", html or "").lower()
        stands.update(w for w in re.findall(r"[a-z\x80-\U0010ffff]+", text) if len(w) > 1)
    total = sum(stands.values())
    words = {w: n for w, n in stands.items() if n >= max(least, share * total)}

    @functools.cache
    def best(token):  # (cost, words) of all ways to cut it
        ways = [(0.0, ())] if not token else []
        for i in range(1, min(24, len(token)) + 1):
            if token[:i] in words and (rest := best(token[i:])):
                ways.append((math.log(total / words[token[:i]]) + rest[0], (token[:i], *rest[1])))
        return min(ways, default=None)

    def features(tokens):
        for t in tokens:
            for x in (y if not y.isdigit() else "0" for y in re.findall("[0-9]+|[^0-9]+", t)):
                yield from best(x)[1] if x.isalpha() and best(x) else (x,)

    for tokens, verdict in judged:
        if verdict:
            seen[verdict].update(features(tokens))
    sums = {v: sum(c.values()) for v, c in seen.items()}
    held = {w for w in seen["block"] | seen["allow"] if sum(c[w] for c in seen.values()) >= max(least, share * sum(sums.values()))}
    low, out = min(sums.values()), []
    for tokens, verdict in judged:
        odds = 0.0
        for w in features(tokens):
            if w in held and low:
                odds += math.log(seen["block"][w] * low / sums["block"] + 1) - math.log(seen["allow"][w] * low / sums["allow"] + 1)
        out.append((verdict, 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))))
    return out


@tables
def test_url_model_like_brute_force(spark):
    """Segmentation, Bayes and verdicts over a whole table."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    by = urlfilter.Rules(registry.URL_RULES)
    rows = df.collect()
    got = {r.page_id: r for r in urlfilter.judge(df, by, urlfilter.fit(df, by, text="html")).collect()}
    want = brute_model([(r.url, r.html) for r in rows], registry.URL_RULES)
    for r, (verdict, p) in zip(rows, want, strict=True):
        assert abs(got[r.page_id].blocked - p) < 1e-6 and got[r.page_id].verdict == (verdict or ("block" if p >= 0.9 else "allow"))


def test_long_urls(spark):
    by = urlfilter.Rules(registry.URL_RULES)
    urls = ["http://" + "ab" * 100_000 + ".info/" + "x/" * 100_000, "http://" + "a." * 100_000 + "example.com/en/1"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.judge(df, by, urlfilter.fit(df, by)).collect()}
    assert got[0].verdict == "allow" and got[1].rule == "com/en/" and len(got[0].path) == 200_001


def test_ordinal(spark, monkeypatch):
    rng = random.Random(3)
    words = {0: "aa bb cc".split(), 1: "dd ee ff".split(), 2: "gg hh ii".split()}
    rows, labels = [], []
    for i in range(300):
        g = i % 3
        rows.append((i, " ".join(rng.choice(words[g] + ["kk", "ll"]) for _ in range(30)), 0.5))
        labels.append((i, int(g == 2), int(g == 0)))
    odd = [(1000, None, 0.0), (1001, "", 0.0), (1002, "gg " * 100_000, 0.0), (None, "gg hh", 0.0), (0, "hh hh", 0.0)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, p_tail double")
    lab = spark.createDataFrame([*labels, (5, None, None), (7, 1, 0), (None, 1, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    model = ordinal.fit(df, lab.where("doc_id % 5 <> 0"))
    got = ordinal.judge(df, model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.p_tail <= 1 and 0 <= r.expected_grade <= 2 and r.kept == (r.p_tail >= 0.5) for r in got)
    held = [abs(r.expected_grade - r.doc_id % 3) < 0.5 for r in got if r.doc_id is not None and 0 < r.doc_id < 300 and r.doc_id % 5 == 0]
    assert np.mean(held) > 0.9 and list(model.thresholds) == sorted(model.thresholds)
    learned = []
    monkeypatch.setattr(ordinal, "learn", lambda tokens, *_: learned.append(len(tokens)))
    for most in (1 << 27, 5000):
        ordinal.fit(df, lab.where("doc_id % 5 <> 0"), most=most)
    assert learned[0] >= 240 and 0 < learned[1] < learned[0] / 2
    empty = ordinal.fit(df, lab.limit(0))
    assert {round(r.p_tail, 6) for r in ordinal.judge(df, empty).collect()} == {round(1 - float(ordinal.logistic(np.array(1.0))), 6)}
    assert ordinal.judge(df.limit(0), model).collect() == []


COLUMNS = {
    "op1_token_files": "doc_id start n_tokens ids_crc32",
    "op2_near_duplicates": "doc_id n_shingles component_id kept",
    "op3_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_language": "doc_id held_out lang_pred score",
    "op5_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op6_substring_dedup": "doc_id n_words n_removed kept_sha256",
    "op7_url_filter": "page_id host path rule verdict",
    "op8_ordinal_quality": "doc_id expected_grade p_tail kept",
    "op9_line_templates": "doc_id n_lines n_dropped kept_sha256",
    "op10_decontamination": "doc_id contaminated item_id score n_items kept",
}


@tables
@pytest.mark.parametrize("name", COLUMNS)
def test_whole_tables(spark, name):
    df = registry.queries()[name](spark, SF)
    table = "pages" if name == "op7_url_filter" else "documents"
    assert df.columns == COLUMNS[name].split()
    own = spark.read.parquet(f"{SF}/{table}.parquet").select(df.columns[0])
    assert sorted(r[0] for r in df.select(df.columns[0]).collect()) == sorted(r[0] for r in own.collect())


@tables
def test_held_out_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = registry.op4_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


@tables
@pytest.mark.parametrize("name", registry.oracle_sql())
def test_like_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cur = c.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    df = registry.queries()[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(cur.fetchall()) == sorted(tuple(r) for r in df.select(names).collect())


@tables
def test_grades_of_unseen_documents(spark):
    """Fitted on odd doc_ids, judged on even ones."""
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    model = ordinal.fit(docs, lab.where("doc_id % 2 = 1"))
    own = ordinal.judge(docs.where("doc_id % 2 = 0"), model).join(lab, "doc_id")
    right = own.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("kept") == F.expr("quality = 1 AND toxic = 0")).cast("int")).alias("share")).first()
    assert right.n > 500 and right.share > 0.95


@tables
def test_rules_like_brute_force(spark):
    """op3's whole result: counts in plain Python, then the learned list in numpy, its first rule that holds rejecting."""
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{x}.parquet") for x in ("documents", "labels"))
    learned = rules.fit(docs, lab)
    got = {r.doc_id: r for r in registry.op3_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    rows = docs.select("doc_id", "text").collect()
    assert learned and len(got) == len(rows)
    for d, text in rows:
        n, chars, symbols, dup, repeats = brute_counts(text)
        words, of = WORD.findall(text or ""), max(n, 1)
        x = np.array([[n, chars / of, symbols / of, dup / of, repeats / of, len(re.findall("[A-Z]", text or "")) / max(chars, 1), (text or "").count("!") / of, len(set(words)) / of]])
        failed = n < 10 or 100 * repeats > 20 * n
        want = (d, n, chars, symbols, dup, repeats, failed, not failed and not any(rules.holds(r, x)[0] for r in learned))
        assert tuple(got[d]) == want
    assert {r.kept for r in got.values() if not r.base_failed} == {True, False}


@tables
def test_rules_on_unseen_documents(spark):
    """Learned from odd doc_ids, held against the labels of even ones, among documents that the base rules pass."""
    docs, lab = (spark.read.parquet(f"/root/testdata/sf0.1/{x}.parquet") for x in ("documents", "labels"))
    lab = lab.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    learned = rules.fit(docs, lab.where("doc_id % 2 = 1"))
    own = rules.judge(docs.where("doc_id % 2 = 0").join(lab, "doc_id", "left_semi"), learned).where("NOT base_failed").join(lab, "doc_id")
    got = {(r.quality, r.kept): r["count"] for r in own.groupBy("quality", "kept").count().collect()}
    assert got[0, False] >= 0.9 * (got[0, False] + got.get((0, True), 0)) > 90
    assert got.get((1, False), 0) <= 0.01 * got[1, True]
