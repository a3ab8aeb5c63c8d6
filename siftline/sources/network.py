"""Network readers as Python data sources. Fetching is behind a function, so that tests answer from tables.

Errors are rows, not exceptions: an answer has its status, body and error. Partitions are as many as asked for, and each
waits between its requests, which bounds the load on the other side.
"""

from __future__ import annotations

import gzip
import json
import os
import socket
import struct
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.charsets import decoded

ANSWER = "key string, url string, status_code int, charset string, body binary, error string"
AGENT = "siftline/1.0"
#: Statuses for which another attempt can't help.
GIVE_UP = (404, 410)


def get(url: str, timeout: float = 15.0) -> tuple[int | None, str | None, bytes | None, str | None]:
    """status, charset, body and error of one request."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as r:
            return r.status, r.headers.get_content_charset(), r.read(), None
    except urllib.error.HTTPError as e:
        return e.code, None, None, str(e)
    except (OSError, ValueError) as e:
        return None, None, None, str(e)


def get_again(url: str, fetch: Callable = get, attempts: int = 3, pause: float = 0.5, wait: Callable = time.sleep) -> tuple:
    """Up to `attempts` requests with doubling pauses; 404, 410 and 500 or more end it at once."""
    got = (None, None, None, "no attempt")
    for n in range(attempts):
        got = fetch(url)
        if got[0] is not None and (got[0] < 400 or got[0] in GIVE_UP or got[0] >= 500):
            return got
        if n + 1 < attempts:
            wait(pause * 2**n)
    return got


def fetch_feed(url: str, fallback: str | None = None, fetch: Callable = get, wait: Callable = time.sleep) -> tuple[bytes, str]:
    """The bytes of a feed and the url that gave them; gzip by the url's ending."""
    error = None
    for i, u in enumerate(x for x in (url, fallback) if x):
        if i:
            wait(1)
        status, _, body, error = fetch(u)
        if status is not None and status < 400 and body is not None:
            return (gzip.decompress(body) if u.endswith(".gz") else body), u
    raise RuntimeError(f"no answer from {url}: {error}")


def resolves(domain: str, timeout: float = 3.0, lookup: Callable = socket.getaddrinfo) -> bool:
    try:
        return bool(lookup(domain, None, socket.AF_INET))
    except OSError:
        return False


# Public resolvers, asked in this order; and the archive's question for a page's latest copy.
RESOLVERS = ["8.8.8.8", "1.1.1.1", "9.9.9.9", "208.67.222.222", "8.8.4.4"]
ARCHIVE = "https://archive.org/wayback/available?url="


def question(domain: str, number: int) -> bytes:
    """A DNS message that asks for a domain's addresses (type A)."""
    labels = domain.rstrip(".").encode("idna").split(b".")
    return struct.pack(">6H", number, 0x0100, 1, 0, 0, 0) + b"".join(bytes([len(x)]) + x for x in labels) + b"\0" + struct.pack(">2H", 1, 1)


def has_address(answer: bytes, number: int) -> bool:
    """Whether a DNS message answers that question with an address."""

    def after_name(at: int) -> int:
        while answer[at]:
            if answer[at] >= 0xC0:
                return at + 2
            at += 1 + answer[at]
        return at + 1

    own, flags, asked, given = struct.unpack(">4H", answer[:8])
    if own != number or flags & 0x800F != 0x8000:
        return False
    at = 12
    for _ in range(asked):
        at = after_name(at) + 4
    for _ in range(given):
        at = after_name(at)
        kind, _, _, size = struct.unpack(">2HIH", answer[at : at + 10])
        if kind == 1 and size == 4:
            return True
        at += 10 + size
    return False


def ask(resolver: str, domain: str, timeout: float = 4.0) -> bool:
    """Whether one resolver knows an address of the domain; `system` is the machine's own."""
    if resolver == "system":
        return resolves(domain)
    number = int.from_bytes(os.urandom(2))
    try:
        with socket.socket(socket.AF_INET, socket.SOCK_DGRAM) as s:
            s.settimeout(timeout)
            s.sendto(question(domain, number), (resolver, 53))
            return has_address(s.recv(4096), number)
    except (OSError, ValueError, IndexError, struct.error):
        return False


def asked(domain: str, resolvers: list[str], one: Callable = ask) -> Iterator[tuple[str, str, bool]]:
    """domain, resolver and ok of each resolver up to the first that knows the domain."""
    for r in resolvers:
        ok = one(r, domain)
        yield domain, r, ok
        if ok:
            return


def archived(domain: str, fetch: Callable = get) -> tuple[str, str | None, str | None]:
    """domain, status and text of the archive's latest copy; nulls without one, or where the archive doesn't answer."""
    status, _, body, _ = fetch(ARCHIVE + urllib.parse.quote(domain))
    try:
        closest = json.loads(body)["archived_snapshots"].get("closest") or {} if status == 200 else {}
    except (ValueError, KeyError, TypeError, AttributeError):
        closest = {}
    if closest.get("status") != "200":
        return domain, closest.get("status"), None
    _, charset, page, _ = fetch(closest["url"])
    return domain, "200", None if page is None else decoded(page, charset)


def each_row(df: DataFrame, column: str, work: Callable, schema: str, workers: int, pause: float = 0.0) -> DataFrame:
    """The rows that `work` gives for each value of a column, by `workers` tasks that wait between values. Values stay with
    the executors: a list may be as long as it likes."""
    kinds = {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)

    def batches(own: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in own:
            for value in batch.column(0).to_pylist():
                rows = list(work(value))
                yield pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], kinds[t]) for t in types], list(names))
                if pause:
                    time.sleep(pause)

    return df.select(column).repartition(workers).mapInArrow(batches, schema)


def answers(df: DataFrame, workers: int = 20, timeout: float = 15.0, fetch: Callable | None = None) -> DataFrame:
    """domain, scheme, attempt, status_code and body (text) for the https and http pages of df's domains. http is asked
    only where https has no answer below 400."""
    one = fetch or (lambda u: get(u, timeout))

    def work(domain: str) -> Iterator[tuple]:
        for scheme in ("https", "http"):
            status, charset, body, _ = one(f"{scheme}://{domain}")
            yield domain, scheme, 0, status, None if body is None else decoded(body, charset)
            if status in (429, 503):
                time.sleep(0 if fetch else 2)
                status, charset, body, _ = one(f"{scheme}://{domain}")
                yield domain, scheme, 1, status, None if body is None else decoded(body, charset)
            if status is not None and status < 400:
                return

    return each_row(df, "domain", work, "domain string, scheme string, attempt int, status_code int, body string", workers)


def names(df: DataFrame, workers: int = 20, resolvers: list[str] = RESOLVERS, one: Callable = ask) -> DataFrame:
    """domain, resolver and ok of df's domains."""
    return each_row(df, "domain", lambda d: asked(d, resolvers, one), "domain string, resolver string, ok boolean", workers)


def list_page(url: str, page: int) -> str:
    """The url of a list's page: by {page} in it, or else by a parameter from the second page on."""
    return url.format(page=page) if "{page}" in url else url if page == 1 else f"{url}{'&' if '?' in url else '?'}page={page}"


def list_pages(df: DataFrame, url: str, workers: int = 1, pause: float = 0.5, fetch: Callable | None = None, knows: Callable = resolves) -> DataFrame:
    """page (text) and html of a list's pages, from df's column page. html is null where the host has no address, where
    nothing below 400 is answered, and where the answer has no body. A list's host gets a request every `pause` seconds from
    each of `workers` tasks."""
    again = {} if fetch is None else {"fetch": fetch, "wait": lambda s: None}

    def work(page: str) -> Iterator[tuple]:
        at = list_page(url, int(page))
        name = urllib.parse.urlsplit(at).hostname
        if name and not knows(name):
            yield page, None
            return
        status, charset, body, _ = get_again(at, **again)
        yield page, None if status is not None and status >= 400 or body is None else decoded(body, charset)

    return each_row(df, "page", work, "page string, html string", workers, pause)


def copies(df: DataFrame, workers: int = 20, fetch: Callable = get) -> DataFrame:
    """domain, closest_status and body of the archive's copies of df's domains."""
    return each_row(df, "domain", lambda d: [archived(d, fetch)], "domain string, closest_status string, body string", workers)


class Piece(InputPartition):
    def __init__(self, keys: list[tuple[str, str]]):
        self.keys = keys


class _Answers(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        urls = [u for u in options.get("urls", "").split("\n") if u]
        template, pages = options.get("template"), int(options.get("pages", "0"))
        self.keys = [(u, u) for u in urls] + [(str(i), template.format(page=i)) for i in range(1, pages + 1) if template]
        self.parts, self.pause = max(1, int(options.get("partitions", "1"))), float(options.get("pause", "0.5"))
        self.timeout = float(options.get("timeout", "15"))

    def partitions(self) -> list[InputPartition]:
        return [Piece(self.keys[i :: self.parts]) for i in range(min(self.parts, max(1, len(self.keys))))]

    def read(self, partition: Piece) -> Iterator[tuple]:
        for i, (key, url) in enumerate(partition.keys):
            if i:
                time.sleep(self.pause)
            status, charset, body, error = get_again(url, lambda u: get(u, self.timeout))
            yield key, url, status, charset, body, error


class HttpSource(DataSource):
    """spark.read.format("siftline_http").option("urls", lines) or .option("template", "…{page}").option("pages", n)."""

    @classmethod
    def name(cls) -> str:
        return "siftline_http"

    def schema(self) -> str:
        return ANSWER

    def reader(self, schema) -> DataSourceReader:
        return _Answers(dict(self.options))


class _Names(_Answers):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.resolvers = options.get("resolvers", "system").split(",")

    def read(self, partition: Piece) -> Iterator[tuple]:
        for key, _ in partition.keys:
            yield from asked(key, self.resolvers)


class DnsSource(DataSource):
    """spark.read.format("siftline_dns").option("urls", domains by line).option("resolvers", "8.8.8.8,system"): domain,
    resolver and ok."""

    @classmethod
    def name(cls) -> str:
        return "siftline_dns"

    def schema(self) -> str:
        return "domain string, resolver string, ok boolean"

    def reader(self, schema) -> DataSourceReader:
        return _Names(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(HttpSource)
    spark.dataSource.register(DnsSource)
