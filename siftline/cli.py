"""Commands over files: python -m siftline COMMAND --help."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import markup
from .functions.strings import fix_mojibake, iso_utc
from .functions.urls import fetch_key
from .operators import brands as B
from .operators import cleaning, extraction, features, fetching, lists, relational, seed
from .functions.values import ALLOW_LIST, DENY_LIST, SCAM_LIST, TRUSTED_LIST
from .schemas import PAGE_TEXT, RAW_HTML, SEED
from .session import session
from .sources import feeds, files, network, sinks

#: Lists that are crawled: the list they belong to, their address, whether they have pages, and how their items are found.
CRAWLS = {
    "scam": ("black", SCAM_LIST, True, markup.scam_items),
    "trusted": ("white", TRUSTED_LIST, True, markup.trusted_items),
    "deny": ("black", DENY_LIST, False, markup.report_items),
    "allow": ("white", ALLOW_LIST, False, markup.report_items),
}
#: Pages of a list that are asked for before it is looked whether the list has ended.
WAVE = 16


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftline", description=__doc__)
    p.add_argument("--root", default="data", help="folder of lists, raw pages, texts, features and reports")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("crawl", help="crawl public lists and merge them")
    c.add_argument("--source", default="all", choices=[*CRAWLS, "all", "black", "white"])
    c.add_argument("--template", action="append", default=[], metavar="NAME=URL", help="another address for a list; {page} in it stands for the page's number")
    c.add_argument("--max-pages", type=int, help="pages of each list at most; without it all that its first page tells of")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--check-status", nargs="?", const="black", choices=["black", "white", "both"])
    c = sub.add_parser("collect", help="read feed snapshots and merge them")
    c.add_argument("--sources", default="default")
    c.add_argument("--snapshots", required=True, help="folder with a file or folder for each feed")
    c.add_argument("--download", action="store_true", help="fetch the feeds into that folder first")
    c.add_argument("--per-source-limit", type=int, default=5000)
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--no-merge", action="store_true")
    c = sub.add_parser("clean-lists")
    c.add_argument("--source", default="both", choices=["black", "white", "both"])
    c = sub.add_parser("fetch", help="fetch the lists' pages")
    c.add_argument("--source", default="both", choices=["black", "white", "both"])
    c.add_argument("--limit", type=int)
    c.add_argument("--workers", type=int, default=20)
    c.add_argument("--fix-mojibake", metavar="FILE", help="repair a file of pages instead")
    c.add_argument("--min-words", type=int, default=50)
    c.add_argument("--output", metavar="PATH", help="where records go; domains that are there already are not fetched again")
    c.add_argument("--batch", type=int, default=2000, help="domains whose records are written together")
    c = sub.add_parser("clean-pages")
    c.add_argument("--input")
    c.add_argument("--source", default="both", choices=["black", "white", "both"])
    c.add_argument("--min-words", type=int, default=200)
    c.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("extract")
    c.add_argument("--input")
    c.add_argument("--source", default="both", choices=["black", "white", "both"])
    c.add_argument("--limit", type=int)
    for name in ("init", "seed", "features", "all"):
        c = sub.add_parser(name)
        c.add_argument("--blacklist")
        c.add_argument("--whitelist")
        c.add_argument("--brands")
        c.add_argument("--phishing-limit", type=int, default=75)
        c.add_argument("--legitimate-limit", type=int, default=75)
        c.add_argument("--seed")
    return p


def chosen(source: str) -> list[str]:
    return ["black", "white"] if source == "both" else [source]


def list_path(root: str, which: str) -> str:
    return f"{root}/{which}_list.txt"


def print_row(what: str, df: DataFrame) -> None:
    for r in df.collect():
        print(what, *(f"{k}={v}" for k, v in r.asDict().items()))


def merge(spark: SparkSession, root: str, which: str, new: DataFrame, dry_run: bool) -> None:
    path = list_path(root, which)
    old = files.domain_set(spark, path)
    print_row(which, relational.merge_stats(old, new))
    if not dry_run:
        sinks.write_domains(relational.merged(old, new), path)


def crawled(spark: SparkSession, name: str, url: str, to: str, most: int | None = None, **how) -> DataFrame:
    """The domains of a list, page by page. The first page tells how many there are; the list ends at the first reachable
    page without items. Pages are kept in `to` as they come, a few at a time, so that what was fetched outlasts a crawl that
    breaks off."""
    _, _, paged, items = CRAWLS[name]
    found, last, at = lambda: spark.read.schema("page int, items array<string>, total int").json(to), 1, 0
    while at < last:
        wave = [(str(p),) for p in range(at + 1, min(last, at + WAVE if at else 1) + 1)]
        got = network.list_pages(spark.createDataFrame(wave, "page string"), url, **how)
        rows = got.select(F.col("page").cast("int").alias("page"), F.when(F.col("html").isNotNull(), items(F.col("html"))).alias("items"), F.when(F.col("page") == "1", markup.page_count(F.col("html"), most)).alias("total"))
        sinks.append_records(rows, to)
        first = at == 0
        at += len(wave)
        new = found().where(F.col("page") > at - len(wave)).agg(F.max("total").alias("total"), F.count_if((F.size("items") == 0) & (F.col("page") > 1)).alias("ends")).first()
        if first:
            last = new.total or 0 if paged else 1
        if new.ends:
            break
    kept = relational.take_while_filled(found(), [], "page", F.col("items").isNotNull(), F.size("items") > 0)
    return kept.select(F.explode("items").alias("domain")).distinct()


def crawl(spark: SparkSession, a: argparse.Namespace, **how) -> None:
    templates = dict(t.split("=", 1) for t in a.template)
    for name, (which, url, _, _) in CRAWLS.items():
        if a.source in ("all", which, name):
            new = crawled(spark, name, templates.get(name, url), f"{a.root}/raw/crawl_{name}_{datetime.now(UTC):%Y%m%d_%H%M%S_%f}", a.max_pages, **how)
            merge(spark, a.root, which, new, a.dry_run)
    if a.check_status:
        for which in chosen(a.check_status):
            print_row(which, statuses(files.domain_set(spark, list_path(a.root, which))).groupBy("class").count())


def statuses(domains: DataFrame, workers: int = 20) -> DataFrame:
    """domain and class of each domain, by asking the system's resolver and the sites."""
    dns = network.names(domains, workers, ["system"]).groupBy("domain").agg(F.bool_or("ok").alias("dns_ok"))
    http = network.answers(domains, workers, 10).where("status_code IS NOT NULL AND attempt = 0")
    first = http.groupBy("domain").agg(F.max_by("status_code", F.col("scheme") == "https").alias("http_status"))
    own = dns.join(first, "domain", "left")
    return own.select("domain", fetching.liveness(F.col("dns_ok"), F.col("http_status")).alias("class"))


def download(spark: SparkSession, wanted: list[str], folder: str) -> None:
    """Puts the feeds' bytes in a folder; a feed that gives none is left out."""
    for name in wanted:
        feed = feeds.FEEDS[name]
        try:
            content, url = network.fetch_feed(feed.url, feed.fallback)
        except RuntimeError as e:
            print(f"{name}: {e}")
            continue
        sinks.write_bytes(spark, f"{folder}/{name}", content)
        print(f"{name}: {len(content)} bytes from {url}")


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.download:
        download(spark, feeds.selected(a.sources), a.snapshots)
    paths = {n: f"{a.snapshots}/{n}" for n in feeds.selected(a.sources)}
    there = {n: p for n, p in paths.items() if files.exists(spark, p)}
    for n in paths.keys() - there.keys():
        print(f"{n}: no snapshot")
    if not there:
        return
    rows = feeds.collected(spark, there, a.per_source_limit or None).withColumn("collected_at", iso_utc(F.current_timestamp()))
    to = f"{a.root}/raw/source_records_{datetime.now(UTC):%Y%m%d_%H%M%S}"
    sinks.write_records(rows, to)
    if not a.no_merge:
        rows = spark.read.schema("label int, domain string").json(to)
        for label, which in ((1, "black"), (0, "white")):
            merge(spark, a.root, which, relational.route(rows, label), a.dry_run)


def clean_lists(spark: SparkSession, a: argparse.Namespace) -> None:
    for which in chosen(a.source):
        path = list_path(a.root, which)
        lines = files.numbered_lines(spark, path).where("value != ''")
        print_row(which, lists.clean_stats(lines, which == "black"))
        sinks.replace(lists.cleaned(lines, which == "black"), path, backup=True)


def fetch(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.fix_mojibake:
        fixed = sinks.repair_records(spark, a.fix_mojibake, RAW_HTML, {"_mojibake_fixed": fix_mojibake(F.col("html"), 0) != F.col("html"), "html": fix_mojibake(F.col("html"), 0)})
        return sinks.replace(fixed.orderBy("line_no").select("value"), a.fix_mojibake)
    for which in chosen(a.source):
        to = a.output or f"{a.root}/html/raw/{which}list_{datetime.now(UTC):%Y%m%d_%H%M%S}.jsonl"
        own = files.domain_lines(spark, list_path(a.root, which), a.limit).select(fetch_key(F.col("value")).alias("domain")).distinct()
        if files.exists(spark, to):
            own = own.join(spark.read.schema("url string, source string").json(to).where(F.col("source") == which).select(F.col("url").alias("domain")), "domain", "left_anti")
        fetch_batches(spark, own, which, to, a)


def fetch_batches(spark: SparkSession, domains: DataFrame, which: str, to: str, a: argparse.Namespace, **how) -> None:
    """Fetches the pages of domains, some --batch of them at a time, and adds each batch's records to `to` when they are
    there: a job that breaks off keeps what came before, and with the same --output goes on with the rest."""
    domains = domains.persist()
    many = max(1, -(-domains.count() // a.batch))
    for i in range(many):
        own = domains.where(F.pmod(F.xxhash64("domain"), F.lit(many)) == i)
        names = own.where("domain != ''")
        dns = network.names(names, a.workers, **({"one": how["one"]} if "one" in how else {})).persist()
        asked = {"fetch": how["fetch"]} if "fetch" in how else {}
        http = network.answers(fetching.resolved(dns).where("dns_ok"), a.workers, **asked).persist()
        missing = names.join(http.where("status_code < 400").select("domain").distinct(), "domain", "left_anti")
        archive = network.copies(missing, a.workers, **asked).persist()
        out = fetching.outcomes(own, dns, http, archive, a.min_words)
        sinks.append_records(out.withColumns({"source": F.lit(which), "fetched_at": iso_utc(F.current_timestamp())}), to)
        for df in (dns, http, archive):
            df.unpersist()
    domains.unpersist()


def clean_pages(spark: SparkSession, a: argparse.Namespace) -> None:
    source = None if a.input or a.source == "both" else a.source
    at = files.records(spark, a.input, RAW_HTML, keep_malformed=True) if a.input else files.raw_pages(spark, f"{a.root}/html/raw", RAW_HTML, source, cleaned=False)
    rows = cleaning.with_reason(at, a.min_words, malformed="malformed")
    stats = cleaning.clean_stats(rows, a.min_words)
    print_row("", stats)
    print_row("all", cleaning.grand_total(stats))
    if not a.dry_run:
        sinks.write_raw(rows.where("reason = 'kept'"), f"{a.root}/html/cleaned/{a.source}")


def extract(spark: SparkSession, a: argparse.Namespace) -> None:
    source = None if a.input or a.source == "both" else a.source
    pages = files.records(spark, a.input, RAW_HTML, keep_malformed=True) if a.input else files.raw_pages(spark, f"{a.root}/html/raw", RAW_HTML, source)
    if a.limit:
        pages = pages.where(F.col("line_no") <= a.limit)
    print_row("", extraction.extract_stats(pages, malformed="malformed"))
    sinks.write_by_source(extraction.extracted(pages.where("NOT malformed")), f"{a.root}/html/processed")


def _content(spark: SparkSession, root: str) -> DataFrame:
    at = f"{root}/html/processed"
    if not files.exists(spark, at):
        return seed.content_index(spark.createDataFrame([], f"{PAGE_TEXT}, file string, line_no long"))
    return seed.content_index(files.records(spark, f"{at}/*/*.json", PAGE_TEXT))


def make_seed(spark: SparkSession, a: argparse.Namespace) -> None:
    black, white = a.blacklist or list_path(a.root, "black"), a.whitelist or list_path(a.root, "white")
    crawled = _content(spark, a.root).select("domain")
    rows = seed.seed(files.domain_lines(spark, black, missing_ok=True), files.domain_lines(spark, white, missing_ok=True), files.brands(spark, a.brands or f"{a.root}/brands.json"), crawled, a.phishing_limit, a.legitimate_limit, black.rsplit("/", 1)[-1], f"{datetime.now(UTC):%Y-%m-%dT%H:%M:%S+00:00}")
    sinks.write_records(rows.coalesce(1), f"{a.root}/raw/seed_dataset")
    own = spark.read.schema(SEED).json(f"{a.root}/raw/seed_dataset")
    sinks.write_csv(own, f"{a.root}/raw/urls_seed", ["record_id", "url", "domain", "label", "source"])
    n = seed.seed_stats(own, crawled).first()
    sinks.write_report(spark, f"{a.root}/reports/seed.md", "Seed dataset", [f"Records: {n.records}", f"Phishing records: {n.phishing}", f"Legitimate records: {n.legitimate}", f"Phishing records with local extracted text: {n.phishing_with_text}"], datetime.now(UTC))


def make_features(spark: SparkSession, a: argparse.Namespace) -> None:
    seeds = spark.read.schema(SEED).json(a.seed or f"{a.root}/raw/seed_dataset")
    rows = features.features(seeds, _content(spark, a.root), B.catalog(files.brands(spark, a.brands or f"{a.root}/brands.json")))
    sinks.write_records(rows, f"{a.root}/features/seed_features")
    n = features.feature_stats(spark.read.schema("text string").json(f"{a.root}/features/seed_features")).first()
    sinks.write_report(spark, f"{a.root}/reports/features.md", "Feature extraction", [f"Input records: {n.records}", f"Records missing processed text evidence: {n.missing_text}"], datetime.now(UTC))


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(args)
    spark = spark or session()
    steps = {"crawl": [crawl], "collect": [collect], "clean-lists": [clean_lists], "fetch": [fetch], "clean-pages": [clean_pages], "extract": [extract]}
    steps |= {"init": [], "seed": [make_seed], "features": [make_features], "all": [make_seed, make_features]}
    if a.command in ("init", "seed", "features", "all"):
        sinks.workspace(spark, a.root)
    for step in steps[a.command]:
        step(spark, a)
