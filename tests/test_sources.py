"""Readers, writers, network sources, the stream and the commands, on files of their own."""

import gzip
import io
import json
import zipfile
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from siftline import cli
from siftline.schemas import RAW_HTML
from siftline.sources import feeds, files, network, sinks
from siftline.streaming import incremental


def test_lists(spark, tmp_path):
    f = tmp_path / "a_black.txt"
    f.write_text(" B.example\r\n\na.example\nb.example\n")
    assert [r.domain for r in files.domain_set(spark, f"file://{f}").orderBy("domain").collect()] == ["a.example", "b.example"]
    assert [tuple(r) for r in files.domain_lines(spark, f"file://{f}").collect()] == [(1, "B.example"), (3, "a.example"), (4, "b.example")]
    assert files.domain_lines(spark, f"file://{f}", 2).count() == 2
    assert files.domain_set(spark, f"file://{f}.no").count() == files.domain_lines(spark, f"file://{f}.no", missing_ok=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.domain_lines(spark, f"file://{f}.no").collect()


def test_records(spark, tmp_path):
    (tmp_path / "x_black_1.jsonl").write_text('{"url":"u","html":"h","more":1}\n\n{bad\n{"url":null}\n')
    (tmp_path / "x_white_1_cleaned.jsonl").write_text('{"url":"w"}\n')
    own = files.records(spark, f"file://{tmp_path}/x_black_1.jsonl", RAW_HTML, keep_malformed=True).orderBy("line_no").collect()
    assert [(r.line_no, r.url, r.malformed) for r in own] == [(1, "u", False), (3, None, True), (4, None, False)]
    assert files.records(spark, f"file://{tmp_path}/x_black_1.jsonl", RAW_HTML).count() == 2
    every = files.raw_pages(spark, f"file://{tmp_path}", RAW_HTML)
    assert {(r.list, r.url) for r in every.where("NOT malformed").collect()} == {("black", "u"), ("black", None), ("white", "w")}
    assert files.raw_pages(spark, f"file://{tmp_path}", RAW_HTML, "white", cleaned=False).count() == 0


def test_brand_file(spark, tmp_path):
    data = {"_meta": {"a": 1}, "banks": [{"name": "A", "official_domains": ["a.example"], "aliases": [], "sector": "s"}, {"name": "B"}], "other": "text", "shops": [{"name": "C", "aliases": ["c"]}]}
    (tmp_path / "b.json").write_text(json.dumps(data))
    got = files.brands(spark, f"file://{tmp_path}/b.json").orderBy("brand_no").collect()
    assert [(r.category, r.name, r.official_domains) for r in got] == [("banks", "A", ["a.example"]), ("banks", "B", None), ("shops", "C", None)]


def snapshots(tmp_path):
    (tmp_path / "openphish").write_bytes("#c\n!c\n//c\n1,foo.example\nhttps://a.example/x,y\n\nnodot\x0bb.example \xff\n".encode("latin-1"))
    (tmp_path / "phishing_database_domains").write_text("foo.example\nbar.example/x\n")
    (tmp_path / "phishtank").write_text('phish_id,url,target,submission_time,verification_time\n1, http://a.example/1 ,T,s,v\n2,bad,T,s,v\n3,"http://b.example/""q""",T,s,v\n')
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("readme", "x")
        z.writestr("top.csv", "1,x.example\nn,y.example\nonly\n3,bad\n4,z.example\n")
    (tmp_path / "tranco_top").write_bytes(raw.getvalue())
    (tmp_path / "urlhaus_malware").write_text("http://m.example/x\n")
    return {n: f"file://{tmp_path}/{n}" for n in feeds.FEEDS if (tmp_path / n).exists()}


def test_feeds(spark, tmp_path):
    paths = snapshots(tmp_path)
    plain = [(r.line_no, r.domain, r.url) for r in feeds.snapshot(spark, "openphish", paths["openphish"]).orderBy("line_no").collect()]
    assert plain == [(4, "foo.example", "http://foo.example"), (5, "a.example", "https://a.example/x,y")]
    assert [r.url for r in feeds.snapshot(spark, "phishing_database_domains", paths["phishing_database_domains"]).orderBy("line_no").collect()] == ["http://foo.example", "http://bar.example"]
    assert [(r.line_no, r.phish_id, r.url) for r in feeds.snapshot(spark, "phishtank", paths["phishtank"]).orderBy("line_no").collect()] == [(2, "1", "http://a.example/1"), (4, "3", 'http://b.example/"q"')]
    assert [(r.line_no, r["rank"], r.domain) for r in feeds.snapshot(spark, "tranco_top", paths["tranco_top"], 2).orderBy("line_no").collect()] == [(1, 1, "x.example"), (2, None, "y.example")]
    every = feeds.collected(spark, paths).collect()
    assert sum(r.domain == "foo.example" for r in every) == 1 and {r.label for r in every} == {1, 0, -1}
    assert feeds.selected("default") == feeds.DEFAULT and len(feeds.selected("all")) == 6 and feeds.selected("openphish, phishtank") == ["openphish", "phishtank"]
    with pytest.raises(ValueError, match="nope"):
        feeds.selected("openphish,nope")


def test_network_rules():
    asked, waits = [], []

    def fetch(url, answers={"a": [503], "b": [404], "c": [None, None, 200], "d": [None] * 9, "e": [429, 200]}):  # noqa: B006
        asked.append(url)
        s = answers[url].pop(0)
        return s, None, b"x" if s == 200 else None, None if s == 200 else "e"

    assert [network.get_again(u, fetch, wait=waits.append)[0] for u in "abcde"] == [503, 404, 200, None, 200]
    assert "".join(asked) == "abcccdddee" and waits == [0.5, 1.0, 0.5, 1.0, 0.5]
    feed = lambda u: (200, None, gzip.compress(b"z"), None) if u.endswith(".gz") else (500, None, None, "no")
    assert network.fetch_feed("http://x", "http://y.gz", feed, lambda s: None) == (b"z", "http://y.gz")
    with pytest.raises(RuntimeError):
        network.fetch_feed("http://x", None, feed)
    assert network.resolves("x", lookup=lambda *a: [1]) and not network.resolves("no such host.invalid", lookup=lambda *a: (_ for _ in ()).throw(OSError()))


def test_resolvers_and_archive():
    q = network.question("a.example", 7)
    name = b"\x01a\x07example\x00"
    assert q == b"\x00\x07\x01\x00\x00\x01\x00\x00\x00\x00\x00\x00" + name + b"\x00\x01\x00\x01"
    head = lambda n, flags=0x8180: n.to_bytes(2) + flags.to_bytes(2) + b"\x00\x01\x00\x02\x00\x00\x00\x00" + name + b"\x00\x01\x00\x01"
    alias = b"\xc0\x0c\x00\x05\x00\x01\x00\x00\x00\x09\x00\x02\xc0\x0c"
    address = b"\xc0\x0c\x00\x01\x00\x01\x00\x00\x00\x09\x00\x04\x7f\x00\x00\x01"
    assert network.has_address(head(7) + alias + address, 7) and not network.has_address(head(8) + alias + address, 7)
    assert not network.has_address(head(7) + alias + alias, 7) and not network.has_address(head(7, 0x8183) + alias + address, 7)
    assert list(network.asked("d", ["x", "y", "z"], lambda r, d: r == "y")) == [("d", "x", False), ("d", "y", True)]
    told = {network.ARCHIVE + "ok": (200, None, b'{"archived_snapshots":{"closest":{"status":"200","url":"u"}}}', None), "u": (200, None, b"page", None), network.ARCHIVE + "old": (200, None, b'{"archived_snapshots":{"closest":{"status":"404"}}}', None), network.ARCHIVE + "no": (200, None, b'{"archived_snapshots":{}}', None), network.ARCHIVE + "bad": (200, None, b"<html>", None)}
    fetch = lambda u: told.get(u, (None, None, None, "e"))
    assert [network.archived(d, fetch) for d in ("ok", "old", "no", "bad", "out")] == [("ok", "200", "page"), ("old", "404", None), ("no", None, None), ("bad", None, None), ("out", None, None)]


def test_network_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "domain string")

    def fetch(u):
        return {"https://a": (200, None, b"A", None), "https://b": (503, None, None, "e"), "http://b": (200, "latin-1", b"\xe9", None), "http://c": (404, None, None, "e")}.get(u, (None, None, None, "e"))

    got = sorted((r.domain, r.scheme, r.attempt, r.status_code, r.body) for r in network.answers(df, 2, fetch=fetch).collect())
    assert [g for g in got if g[3]] == [("a", "https", 0, 200, "A"), ("b", "http", 0, 200, "é"), ("b", "https", 0, 503, None), ("b", "https", 1, 503, None), ("c", "http", 0, 404, None)]
    dns = network.names(df, 2, ["x", "y"], lambda r, d: d == "a" or (d, r) == ("b", "y")).collect()
    assert sorted((r.domain, r.resolver) for r in dns if r.ok) == [("a", "x"), ("b", "y")] and len(dns) == 1 + 2 + 2 + 2
    assert {r.domain for r in network.copies(df, 2, fetch).collect()} == {"a", "b", "c", "d"}
    assert network.answers(df.limit(0), 2, fetch=fetch).collect() == []


def test_network_sources(spark, tmp_path):
    network.register(spark)
    f = tmp_path / "page"
    f.write_text("hello")
    got = spark.read.format("siftline_http").option("urls", f"file://{f}\nfile://{f}.no").option("partitions", 2).option("pause", 0).load().collect()
    assert sorted((r.body or b"").decode() for r in got) == ["", "hello"] and sum(r.error is not None for r in got) == 1
    pages = spark.read.format("siftline_http").option("template", f"file://{tmp_path}/{{page}}").option("pages", 3).option("pause", 0).load()
    assert sorted(r.key for r in pages.collect()) == ["1", "2", "3"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b",), ("A",), ("a",)], "domain string")
    sinks.write_domains(df, f"file://{tmp_path}/l.txt")
    assert (tmp_path / "l.txt").read_text() == "A\na\nb\n"
    sinks.replace(files.domain_set(spark, f"file://{tmp_path}/l.txt").orderBy("domain"), f"file://{tmp_path}/l.txt", backup=True)
    assert (tmp_path / "l.txt").read_text() == "a\nb\n" and (tmp_path / "l.txt.bak").read_text() == "A\na\nb\n"
    sinks.write_records(spark.createDataFrame([(1, None)], "a int, b string"), f"file://{tmp_path}/r")
    assert [json.loads(x) for p in (tmp_path / "r").glob("part-*") for x in p.read_text().splitlines()] == [{"a": 1, "b": None}]
    (tmp_path / "p.jsonl").write_text('{bad\n{"url":"u","html":"x"}\n')
    fixed = sinks.repair_records(spark, f"file://{tmp_path}/p.jsonl", RAW_HTML, {"_mojibake_fixed": F.lit(True)}).orderBy("line_no").collect()
    assert fixed[0].value == "{bad" and json.loads(fixed[1].value)["_mojibake_fixed"] is True
    assert len(sinks.workspace(spark, f"file://{tmp_path}/w")) == 3 and sinks.workspace(spark, f"file://{tmp_path}/w") == []
    sinks.write_report(spark, f"file://{tmp_path}/w/x.md", "T", ["a: 1"], datetime(2024, 1, 1, tzinfo=UTC))
    assert (tmp_path / "w/x.md").read_text() == "# T\n\nGenerated: 2024-01-01T00:00:00+00:00\n\n- a: 1\n"


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put = lambda n, *urls: (tmp_path / f"in/{n}.json").write_text("\n".join(json.dumps({"url": u, "html": f"<p>words of {u}</p>", "source": "black", "fetched_at": "2024-01-01T00:00:00+00:00"}) for u in urls))
    for n, us in ((1, ["a", "A ", "b"]), (2, ["b", "c"])):
        put(n, *us)
        q = incremental.extract(incremental.unique_pages(incremental.pages(spark, f"file://{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/cp")
        q.awaitTermination(120)
    got = spark.read.json(f"file://{tmp_path}/out").collect()
    assert sorted(r.url.strip().lower() for r in got) == ["a", "b", "c"] and all(r.text.startswith("words of") for r in got)


def test_commands(spark, tmp_path, capsys):
    root = tmp_path / "data"
    root.mkdir()
    (root / "black_list.txt").write_text("*.acme1.example\ngithub.io\nx.example\n")
    (root / "white_list.txt").write_text("w.example\nw.example\n")
    (root / "brands.json").write_text(json.dumps({"banks": [{"name": "Acme", "official_domains": ["acme.example"], "aliases": [], "sector": "s"}]}))
    (root / "html/raw").mkdir(parents=True)
    rows = [{"url": "x.example", "html": f"<title>Acme</title>{'word ' * 250}", "source": "black"}, {"url": "y.example", "html": None, "source": "black"}]
    (root / "html/raw/blacklist_1.jsonl").write_text("\n".join(map(json.dumps, rows)) + "\n{bad\n")
    run = lambda *a: cli.main(["--root", f"file://{root}", *a], spark)
    run("clean-lists")
    assert (root / "black_list.txt").read_text() == "acme1.example\nx.example\n"
    (tmp_path / "snap").mkdir()
    snapshots(tmp_path / "snap")
    run("collect", "--sources", "openphish,tranco_top", "--snapshots", f"file://{tmp_path}/snap")
    assert "foo.example" in (root / "black_list.txt").read_text() and "z.example" in (root / "white_list.txt").read_text()
    run("clean-pages")
    run("extract")
    run("all", "--phishing-limit", "3")
    out = [json.loads(x) for p in (root / "features/seed_features").glob("part-*") for x in p.read_text().splitlines()]
    assert len(out) == 3 + 5 and {r["domain"]: bool(r["text"]) for r in out}["x.example"]
    assert "Records: 8" in (root / "reports/seed.md").read_text() and "kept=1" in capsys.readouterr().out


def test_order_over_many_splits(spark, tmp_path):
    """A file of many splits gives the same lines with the same numbers as one split."""
    (tmp_path / "x_black.jsonl").write_text("".join(f'{{"url":"u{i}","html":"{"h" * (i % 50)}"}}\n' + "\n" * (i % 3 == 0) for i in range(2000)))
    (tmp_path / "y_white.jsonl").write_text("\n".join(f'{{"url":"w{i}"}}' for i in range(300)))
    one = sorted((r.file, r.line_no, r.url) for r in files.raw_pages(spark, f"file://{tmp_path}", RAW_HTML).collect())
    conf = {"spark.sql.files.maxPartitionBytes": "3000", "spark.sql.files.openCostInBytes": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    lines = files.numbered_lines(spark, f"file://{tmp_path}/x_black.jsonl")
    many, parts = files.raw_pages(spark, f"file://{tmp_path}", RAW_HTML), lines.rdd.getNumPartitions()
    got, order = sorted((r.file, r.line_no, r.url) for r in many.collect()), [r.line_no for r in lines.orderBy("line_no").collect()]
    first = [r.line_no for r in files.domain_lines(spark, f"file://{tmp_path}/x_black.jsonl", 10).collect()]
    for k in conf:
        spark.conf.unset(k)
    assert got == one and parts > 10 and order == list(range(1, len(order) + 1)) and first == [1, 3, 4, 5, 7, 8, 9, 11, 12, 13]
    assert [(n, u) for f, n, u in one if f == "x_black.jsonl"][:4] == [(1, "u0"), (3, "u1"), (4, "u2"), (5, "u3")]


def page_of(*items, pages=()):
    return (200, None, ("".join(f'<span class="webkit-box-2">{i}</span>' for i in items) + "".join(f'<a href="?page={p}">' for p in pages)).encode(), None)


def test_crawl_by_page_total(spark, tmp_path, monkeypatch):
    """The first page tells how many pages there are; an empty page ends the list; unreachable ones are left out."""
    monkeypatch.setattr(cli, "WAVE", 2)
    asked = spark.sparkContext.accumulator(0)
    told = {"http://l.example/": page_of("a.example", pages=[2, 9]), "http://l.example/?page=2": page_of("www.b.example/x"), "http://l.example/?page=3": (500, None, None, "e"), "http://l.example/?page=4": page_of("c.example"), "http://l.example/?page=5": page_of(), "http://l.example/?page=6": page_of("late.example")}

    def fetch(u):
        asked.add(1)
        return told.get(u, (404, None, None, "e"))

    crawl = lambda n, **how: sorted(r.domain for r in cli.crawled(spark, "scam", "http://l.example/", f"file://{tmp_path}/{n}", pause=0, fetch=fetch, **{"knows": lambda h: h == "l.example", **how}).collect())
    assert crawl("a") == ["a.example", "b.example", "c.example"] and asked.value == 5
    assert crawl("b", most=2) == ["a.example", "b.example"]
    asked.value = 0
    assert crawl("c", knows=lambda h: False) == [] and asked.value == 0
    assert network.list_page("http://x/{page}.html", 1) == "http://x/1.html" and network.list_page("http://x/?a=b", 2) == "http://x/?a=b&page=2"


def test_crawl_of_all_lists(spark, tmp_path):
    """Without an address of one's own the known ones are asked."""
    html = {cli.CRAWLS["scam"][1]: page_of("s.example"), cli.CRAWLS["trusted"][1]: (200, None, b'<a class="webkit-box-1"><span>t.example </span></a>', None), cli.CRAWLS["deny"][1]: (200, None, b'<i class="_urlText_1exle_106">d.example<', None)}
    a = cli.parser().parse_args(["--root", f"file://{tmp_path}", "crawl"])
    cli.crawl(spark, a, pause=0, fetch=lambda u: html.get(u, (404, None, None, "e")), knows=lambda h: True)
    assert (tmp_path / "black_list.txt").read_text() == "d.example\ns.example\n" and (tmp_path / "white_list.txt").read_text() == "t.example\n"


def test_fetch_goes_on(spark, tmp_path):
    """Each batch is written when it is there; what broke off goes on with the rest."""
    a = cli.parser().parse_args(["fetch", "--batch", "2", "--workers", "1", "--min-words", "1"])
    df = spark.createDataFrame([(f"d{i}.example",) for i in range(9)], "domain string")
    to = f"file://{tmp_path}/black.jsonl"

    def breaks(u):
        if "d3" in u:
            raise KeyError(u)
        return 200, None, b"some words", None

    with pytest.raises(Exception, match="KeyError"):
        cli.fetch_batches(spark, df, "black", to, a, fetch=breaks, one=lambda r, d: True)
    there = {r.url for r in spark.read.json(to).collect()} if files.exists(spark, to) else set()
    left = df.join(spark.createDataFrame([(u,) for u in there], "domain string"), "domain", "left_anti")
    cli.fetch_batches(spark, left, "black", to, a, fetch=lambda u: (200, None, b"some words", None), one=lambda r, d: True)
    assert sorted(r.url for r in spark.read.json(to).collect()) == [f"d{i}.example" for i in range(9)] and len(list((tmp_path / "black.jsonl").glob("part-*"))) > 2
