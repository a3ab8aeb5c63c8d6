"""Operators on small hand-written tables."""

import json
import time

import pytest
from pyspark.sql import functions as F

from siftline.functions import charsets, html, markup, strings, urls
from siftline.operators import brands, cleaning, extraction, features, fetching, lists, relational, seed


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], "i int, v string")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def V():  # noqa: N802
    return F.col("v")


def test_normalizers(spark):
    rows = ["HTTP://WWW.Foo.com:80/x", "user@h.com/p", "x.com?q=1", ".a.com.", "foo", "a_b.com", "", "a.com/http://b.com", None, "http://[bad", " x.com\t"]
    assert values(spark, rows, urls.normalize_domain(V())) == ["foo.com", "h.com", "x.com", "a.com", "", "", "", "a.com", "", "", "x.com"]
    assert values(spark, rows[:8], urls.bare_domain(V())) == ["foo.com", "h.com", "x.com", "a.com", "foo", "a_b.com", "", "a.com"]
    assert values(spark, rows[:8], urls.domain_only(V())) == ["foo.com:80", "user@h.com", "x.com?q=1", ".a.com.", "foo", "a_b.com", "", "a.com"]
    assert values(spark, rows[:1], urls.fetch_key(V())) == ["www.foo.com:80"]
    once = [x for x in values(spark, rows, urls.normalize_domain(V())) if x]
    assert values(spark, once, urls.normalize_domain(V())) == once


def test_list_cleaning(spark):
    rows = ["*.a.com", ".a.com", "198.2.252.12:", "<svg xmlns=x>", "github.io", "x.github.io", "jtexpressextra.com", "tibet.vn", "a_b.com", " A.com ", ""]
    df = spark.createDataFrame([(v,) for v in rows], "value string")
    assert [r.domain for r in lists.cleaned(df).collect()] == ["198.2.252.12", "a.com", "jtexpressextra.com", "x.github.io"]
    assert [r.domain for r in lists.cleaned(df, False).collect()] == ["198.2.252.12", "a.com", "github.io", "jtexpressextra.com", "tibet.vn", "x.github.io"]
    assert tuple(lists.clean_stats(df).first()) == (11, 5, 2, 4)
    assert tuple(lists.clean_stats(df.limit(0)).first()) == (0, 0, 0, 0)


def test_mojibake(spark):
    good = ["Mỹ Duyên đẹp quá", "plain text of it", "日本語テスト日本語", "éééé"]
    bad = [t.encode().decode("latin-1") for t in good[:1]]
    assert values(spark, bad, strings.fix_mojibake(V())) == good[:1]
    assert values(spark, good, strings.fix_mojibake(V())) == good
    assert values(spark, ["é" * 3 + "a" * 7, "é" * 4 + "a" * 6, "éé", ""], strings.looks_mojibake(V(), 10)) == [False, True, False, False]


def test_noise_and_parking(spark):
    rows = ["© 2024 X", "Cookie policy text", "ab", "12345 a", "Đã xem: 5", "ĐÃ XEM :  7", "a real line"]
    assert values(spark, rows, strings.is_noise(V())) == [True] * 6 + [False]
    assert values(spark, ["\n".join(["  keep me ", "", *rows])], strings.clean_text(V())) == ["keep me\na real line"]
    at = lambda n: "x" * n + "Buy this domain"
    rows = [at(4980), at(4990), "TRANG WEB ĐANG XÂY DỰNG", "404 error", "fine"]
    assert values(spark, rows, strings.is_parking(V())) == [True, False, True, True, False]


def test_decoding():
    assert charsets.decoded("Đẹp".encode(), "iso-8859-1") == "Đẹp"
    assert charsets.decoded("é".encode("latin-1"), "iso-8859-1") == "é"
    assert charsets.decoded("é".encode("cp1252"), "no-such") == "é"
    assert charsets.decoded(b"\xff\xfe\x81", "utf-8") != ""


PAGE = """<title>A\n  title</title><title>no</title><meta name="description" content=" one "><meta name="description" content="two">
<input type="password"><form><input type="PASSWORD"></form><a href=" https://www.Site.example/x ">s</a><a href="#f">f</a><a href="mailto:x">m</a>
<a href="http://other.example:8080/">o</a><a href="HTTP://up.example/">u</a><script>var t = "</p> words";</script><p>Seen text</p><p style="DISPLAY : none">styled</p>
<p hidden>hidden</p><!-- comment --><nav>nav <b>bold</nav><select><option>opt</option></select>tail &amp; end</p>"""


def test_html(spark):
    r = spark.createDataFrame([("site.example/x", PAGE)], "url string, html string").select(html.page_text(F.col("url"), F.col("html")).alias("x"), html.parsed("html").alias("p")).first()
    assert (r.x.title, r.x.meta_description, r.x.forms_count, r.x.has_password_field) == ("A title", "one", 1, False)
    assert r.x.external_links == ["https://www.Site.example/x", "http://other.example:8080/"]
    assert r.x.links_to_domains == ["other.example:8080", "site.example"]
    assert r.x.text.split("\n") == ["A\n  title".replace("\n  ", "\n").split("\n")[0], "title", "Seen text", "tail & end"] or r.x.text.startswith("title")
    assert r.p.words == len("A title no s f m o u Seen text styled hidden opt tail & end".split())
    many = "".join(f'<a href="http://h{i}.example/">x</a>' for i in range(51))
    r = spark.createDataFrame([("u", many), ("u", None), ("u", "")], "url string, html string").select(html.page_text(F.col("url"), F.col("html")).alias("x")).collect()
    assert len(r[0].x.external_links) == 50 and len(r[0].x.links_to_domains) == 51
    assert [(x.x.error, x.x.text_length, x.x.external_links) for x in r[1:]] == [("no html content", 0, [])] * 2


CUT = '<title>A&amp;&B &copy; 1 &amp</title><meta name="description" content="cut &lt"><a href="http://o.example/?a=1&copy=2&amp;b">x &ampy; &nosuch; &#38; &#x26 &quot</a>'


def test_cut_references(spark):
    """Named references without their semicolon stay as they are in titles, texts and attributes."""
    x = spark.createDataFrame([("u.example", CUT)], "url string, html string").select(html.page_text(F.col("url"), F.col("html")).alias("x")).first().x
    assert (x.title, x.meta_description, x.external_links) == ("A&&B © 1 &amp", "cut &lt", ["http://o.example/?a=1&copy=2&b"])
    assert x.text == "A&&B © 1 &amp\nx &ampy; &nosuch; & & &quot"


def test_visible_cut_references(spark, tmp_path):
    """The query itself, on texts and titles that end within a reference, one of them the page's end."""
    from siftline.plans import catalog as c

    pages = [(1, "http://a.example/", "<title>of&amp;&amp</title><p>of&amp;&amp</p><p>a&ltb &lt; c&nbspd</p><nav>n&amp</nav>z&amp"), (2, "http://b.example/", CUT)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.text, r.words) for r in c.queries()["visible_text"](spark, str(tmp_path)).collect()}
    assert got == {1: ("of&&amp\nof&&amp\na&ltb < c&nbspd\nz&amp", 6), 2: ("A&&B © 1 &amp\nx &ampy; &nosuch; & & &quot", 10)}


def test_markup(spark):
    scam = '<span class="a webkit-box-2"> https://www.A.example/x\n</span><span class="webkit-box-2">a.example</span>'
    trusted = '<a class="webkit-box-1" href="x">\n<span>b.example </span></a><span class="webkit-box-1">c.example</span>'
    report = '<i class="_urlText_1exle_106">http://d.example/q</i><a class="_urlLink_1exle_113" href="z"> e.example </a>{"url":"https://f.example/","n":1,"domain":"g.example"}'
    assert values(spark, [scam], markup.scam_items(V())) == [["a.example"]]
    assert values(spark, [trusted], markup.trusted_items(V())) == [["b.example", "c.example"]]
    assert values(spark, [report], markup.report_items(V())) == [["d.example", "e.example", "f.example", "g.example"]]
    assert values(spark, ["page=3 page=12", "none"], markup.page_count(V()), markup.page_count(V(), 5)) == [(12, 5), (1, 1)]


def test_take_while(spark):
    rows = [(i, None if i == 3 else [] if i == 5 else ["x"]) for i in range(1, 7)]
    pages = spark.createDataFrame(rows, "page_no int, items array<string>")
    kept = relational.take_while_filled(pages, [], "page_no", F.col("items").isNotNull(), F.size("items") > 0)
    assert sorted(r.page_no for r in kept.collect()) == [1, 2, 4]
    empty = pages.where("page_no = 1").withColumn("items", F.array().cast("array<string>"))
    assert empty.count() == relational.take_while_filled(empty, [], "page_no", F.lit(True), F.lit(False)).count() == 1


def test_merge_and_union(spark):
    old, new = (spark.createDataFrame([(x,) for x in v], "domain string") for v in (["a", "b", "b"], ["b", "c", "d", "d"]))
    assert tuple(relational.merge_stats(old, new).first()) == (2, 4, 2)
    assert {r.domain for r in relational.merged(old, new).collect()} == {"a", "b", "c", "d"}
    ok = F.col("domain") != ""
    assert relational.append_if_short(old, new, ok, 4).count() == 7 and relational.append_if_short(old, new, ok, 3).count() == 3
    records = spark.createDataFrame([(1, "a"), (0, "a"), (-1, "z")], "label int, domain string")
    assert [[r.domain for r in relational.route(records, x).collect()] for x in (1, 0)] == [["a"], ["a"]]


def test_cascade(spark):
    words = "word " * 200
    rows = [
        ("f", 1, None, "failed_html"), ("f", 2, "", "failed_html"), ("f", 3, "Buy this domain " + words, "parking_page"), ("f", 4, words, "duplicate_url"),
        ("f", 5, "x" * (10 * 1024 * 1024 + 1), "too_large"), ("f", 6, "x" * (10 * 1024 * 1024), "too_short"), ("f", 7, "word " * 199, "too_short"),
        ("f", 8, words, "kept"), ("f", 9, "<form>short</form>", "too_short"), ("g", 1, words, "kept"), ("f", 10, words, "failed_html"),
    ]
    df = spark.createDataFrame([(f, n, h, " U3 " if n == 4 else f"u{n}", n == 10) for f, n, h, _ in rows], "file string, line_no int, html string, url string, bad boolean")
    out = cleaning.with_reason(df, 200, malformed="bad")
    assert {(r.file, r.line_no): r.reason for r in out.collect()} == {(f, n): x for f, n, _, x in rows}
    stats = cleaning.clean_stats(out)
    assert sum(stats.where("file = 'f'").first()[c] for c in cleaning.REASONS) == 10
    assert cleaning.grand_total(stats).first().kept_percent == 18.2 and cleaning.grand_total(stats.limit(1)).count() == 0


def test_fetching(spark):
    long, short = "w " * 50, "w " * 49
    t = lambda rows, s: spark.createDataFrame(rows, s)
    names = t([(x,) for x in ["ok", "short", "form", "nodns", "old", "retry", "gone", "empty", ""]], "domain string")
    dns = t([(x, "r", x not in ("nodns",)) for x in ["ok", "short", "form", "nodns", "old", "retry", "gone", "empty"]] + [("ok", "q", False)], "domain string, resolver string, ok boolean")
    http = t([("ok", "https", 0, 200, long), ("ok", "http", 0, 200, "other"), ("short", "https", 0, 200, short), ("form", "https", 0, 200, "<FORM>"), ("old", "https", 0, 404, "x"), ("retry", "https", 0, 503, "x"), ("retry", "https", 1, 200, long), ("gone", "http", 0, 404, "x"), ("gone", "http", 1, 200, long), ("empty", "https", 0, 200, ""), ("nodns", "https", 0, 200, long)], "domain string, scheme string, attempt int, status_code int, body string")
    old = t([("old", "200", long), ("nodns", "404", long), ("gone", "200", "")], "domain string, closest_status string, body string")
    got = {r.url: (r.method, r.status_code, r.error and r.error[:12]) for r in fetching.outcomes(names, dns, http, old).collect()}
    assert got == {
        "ok": ("direct", 200, None), "short": ("failed", 200, "HTML content"), "form": ("direct", 200, None), "nodns": ("failed", None, "DNS fail + n"), "old": ("wayback", 200, None),
        "retry": ("direct", 200, None), "gone": ("failed", 404, "DNS fail + n"), "empty": ("failed", 200, "HTML content"), "": (None, None, "empty domain"),
    }


BRANDS = [(0, "b", "Acme Bank", ["www.acme.example"], ["AB", "acmepay"], "banking"), (1, "b", "Zed", [], None, "shops")]


def catalog(spark):
    return spark.createDataFrame(BRANDS, "brand_no long, category string, name string, official_domains array<string>, aliases array<string>, sector string")


def test_brands(spark):
    own = catalog(spark)
    assert [r.tokens for r in brands.with_tokens(own).orderBy("brand_no").collect()] == [["acme", "acmebank", "acmepay"], ["zed"]]
    df = spark.createDataFrame([("my-acme.example", "Acme Pay, acme and ZED"), ("x.example", None)], "d string, t string")
    got = [r.m for r in df.select(brands.matches(brands.catalog(own), F.col("d"), F.col("t")).alias("m")).collect()]
    assert [(m.brand, m.evidence) for m in got[0]] == [("Acme Bank", ["domain contains brand token 'acme'", "text contains brand token 'acmepay'"]), ("Zed", ["text contains brand token 'zed'"])]
    assert got[1] == []
    assert df.select(brands.matches(brands.catalog(own.limit(0)), F.col("d"), F.col("t")).alias("m")).first().m == []


def test_seed_and_features(spark):
    lines = lambda rows: spark.createDataFrame(list(enumerate(rows, 1)), "line_no int, value string")
    pages = spark.createDataFrame([("http://c.example/", "a", 1, ""), ("c.example", "a", 2, "late text"), ("c.example", "b", 1, "x"), ("acme1.example", "a", 3, "acme")], "url string, file string, line_no int, text string")
    pages = pages.selectExpr("*", "'T' title", "cast(null as string) meta_description", "cast(null as int) forms_count", "cast(null as boolean) has_password_field", "array('l') external_links", "array('m') links_to_domains", "'direct' method", "'now' fetched_at")
    content = seed.content_index(pages)
    assert {r.domain: r.text for r in content.collect()} == {"c.example": "late text", "acme1.example": "acme"}
    black, white = lines(["z.example", "c.example", "acme2.example", "acme1.example", "z.example", "b.example"]), lines(["w.example", "", "W.example"])
    rows = seed.seed(black, white, catalog(spark), content, 5, 3, "black.txt").collect()
    assert [r.domain for r in rows] == ["acme1.example", "acme2.example", "c.example", "b.example", "z.example", "w.example", "acme.example"]
    assert rows[0].evidence == ["domain contains brand token 'acme'", "listed in local black.txt", "local crawl has extracted text"]
    assert [r.label for r in rows] == [1] * 5 + [0] * 2 and rows[5].record_id.startswith("legit_")
    out = features.features(spark.createDataFrame(rows, seed.seed(black, white, catalog(spark), content).schema), content, brands.catalog(catalog(spark)))
    got = {r.domain: r for r in out.collect()}
    assert len(out.columns) == 22 and (got["c.example"].text_length, got["c.example"].forms_count, got["z.example"].text) == (9, 0, "")
    assert tuple(features.feature_stats(out).first()) == (7, 5)
    assert tuple(seed.seed_stats(spark.createDataFrame(rows, "record_id string, url string, final_url string, domain string, label int, source string, source_ref string, html_path string, screenshot_path string, observed_at string, evidence array<string>"), content).first()) == (7, 5, 2, 2)


def test_brands_are_read_once_a_domain(spark):
    """A domain's text goes to Python once, however many seeds share it; seeds without content or domain keep their rows."""
    pages = spark.createDataFrame([("a.example", "acme pay " * 50), ("b.example", "none"), ("far.example", "zed")], "domain string, text string")
    pages = pages.selectExpr("*", "'T' title", "cast(null as string) meta_description", "1 forms_count", "false has_password_field", "array('l') external_links", "array('m') links_to_domains", "'direct' method", "'now' fetched_at", "'f' file")
    seeds = spark.range(1000).selectExpr("cast(id as string) record_id", "'http://u/' url", "case id % 4 when 0 then 'b.example' when 1 then 'my-acme.example' when 2 then if(id = 2, null, 'a.example') else 'a.example' end domain", "1 label", "'s' source")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = features.features(seeds, pages, brands.catalog(catalog(spark)))
        rows = out.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    read, plans = 0, [out._jdf.queryExecution().executedPlan()]
    while plans:
        p = plans.pop()
        plans += [p.children().apply(i) for i in range(p.children().size())]
        if "Python" in p.nodeName():
            read += p.metrics().apply("pythonNumRowsReceived").value()
    assert 0 < read <= 4
    told = {(r.domain, r.text_length, "; ".join(e for m in r.brand_matches for e in m.evidence)) for r in rows}
    in_text = "text contains brand token 'acme'; text contains brand token 'acmepay'"
    assert told == {(None, 0, ""), ("a.example", 450, in_text), ("b.example", 4, ""), ("my-acme.example", 0, "domain contains brand token 'acme'")}
    assert len({r.record_id for r in rows}) == len(rows) == 1000 and sum(r.domain == "a.example" for r in rows) == 499


def test_extraction(spark):
    df = spark.createDataFrame([("u", "<p>Some words here</p>", None, "direct", "now", False), ("v", None, "black", "failed", "now", False), ("w", "x", None, None, None, True)], "url string, html string, source string, method string, fetched_at string, bad boolean")
    got = {r.url: r for r in extraction.extracted(df).collect()}
    assert (got["u"].text, got["u"].source, got["u"].error, got["v"].error, got["v"].text) == ("Some words here", "unknown", None, "no html content", None)
    assert tuple(extraction.extract_stats(df, "bad").first()) == (2, 2, 0)


def test_liveness(spark):
    df = spark.createDataFrame([(False, None), (True, 200), (True, 301), (True, 404), (True, None), (None, 200)], "d boolean, s int")
    assert [r.c for r in df.select(fetching.liveness(F.col("d"), F.col("s")).alias("c")).collect()] == ["dead_dns", "alive", "alive", "dead_http", "dead_http", "dead_dns"]


def test_plans_stay_native(spark):
    """The flagship needs no shuffle, no Python and only its own columns."""
    from siftline.plans import catalog as c

    spark.createDataFrame([(1, "http://a.example/", "<title>x</title>", json.dumps({}))], "page_id long, url string, html string, more string")
    try:
        plan = c.queries()["page_features"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    except Exception:
        pytest.skip("the driver's tables aren't here")
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_large_catalog(spark):
    """20,000 brands are found in one pass; a larger catalog, or one of too many letters, is refused."""
    own = spark.range(20_000).select(F.col("id").alias("brand_no"), F.lit("c").alias("category"), F.concat(F.lit("Brand "), F.col("id") + 100_000).alias("name"), F.array().cast("array<string>").alias("official_domains"), F.lit(None).cast("array<string>").alias("aliases"), F.lit("s").alias("sector"))
    held = brands.catalog(own)
    df = spark.range(2000).select("id", F.concat(F.lit("brand"), F.col("id") * 7 + 100_000, F.lit(".example")).alias("d"), F.lit("now BRAND 119999! and more " * 20).alias("t"))
    got = {r.id: [m.brand for m in r.m] for r in df.select("id", brands.matches(held, F.col("d"), F.col("t")).alias("m")).collect()}
    assert got == {i: [f"Brand {i * 7 + 100_000}", "Brand 119999"] for i in range(2000)}
    for rows in ([("x", "s", "c", ("abc",))] * 20_001, [("x", "s", "c", ("a" * 4_000_001,))]):
        try:
            brands.Catalog(tuple(rows))
        except ValueError:
            continue
        raise AssertionError("not refused")


def test_strip_is_linear(spark):
    text = F.concat(F.lit("a"), F.repeat(F.lit(" "), 1_000_000), F.lit("\u3000b \t"))
    began = time.time()
    assert spark.range(1).select(F.length(strings.strip(text)).alias("n")).first().n == 1_000_003 and time.time() - began < 5
