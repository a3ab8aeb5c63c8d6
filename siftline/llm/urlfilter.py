"""URL filters: rules on host and path first, then host word segmentation and naive Bayes.

Concatenated names are split into words by Viterbi over a unigram model; a multinomial naive Bayes over the words of
host and path decides where no rule fits. All of it is learned from the pages: the unigrams are counts of what stands as
a word, that is tokens of paths, of host labels with hyphens and of the pages' texts. A whole label isn't a word by its
own count, or a frequent name would vouch for itself; what words don't cover stays whole. The Bayes counts are those of
the segmented tokens of all urls that a rule decides. Labels of a host or path that a rule itself names are left out, or
the model would only learn the rules by heart.

All tokens are counted, at every size. The model takes those that make up a share of `share` of all and are seen `least`
times, so it has 1 / share entries at most, whatever the input, and no verdict turns on a rare token.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: (host, path, verdict)
Rule = tuple[str, str, str]
LOWER = {i: i + 32 for i in range(65, 91)}
PARTS = re.compile(r"[^a-z0-9\x80-\U0010ffff]+")
DIGITS = re.compile(r"[0-9]+|[^0-9]+")
URL = re.compile(r"[^/?#]*")
PATH = re.compile(r"[^?#]*")

TAG, TEXT_WORD = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>"), re.compile(r"[a-z\x80-\U0010ffff]+")
#: Tokens up to this length are remembered once segmented.
REMEMBERED = 64


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path; both empty for null or without `://`."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    host = URL.match(url, at + 3)
    return host[0].translate(LOWER), PATH.match(url, host.end())[0]


class Rules:
    """A rule fits its host and all subdomains where the path starts with its own; the longest wins, then the longer host."""

    def __init__(self, rules: list[Rule], most: int = 1_000_000):
        if len(rules) > most:
            raise ValueError(f"{len(rules)} rules; {most} at most go to each executor")
        self.by_host: dict[str, list[tuple[str, str]]] = {}
        for host, path, verdict in rules:
            self.by_host.setdefault(host.translate(LOWER), []).append((path, verdict))
        self.named = {w for host, path, _ in rules for w in PARTS.split(host.translate(LOWER) + "/" + path.translate(LOWER)) if w}

    def __call__(self, host: str, path: str) -> tuple[str | None, str | None]:
        best, at = (0, 0, None, None), 0
        while host:
            own = host[at:]
            for start, verdict in self.by_host.get(own, ()):
                if path.startswith(start) and (len(own) + len(start), len(own)) > best[:2]:
                    best = (len(own) + len(start), len(own), own + start, verdict)
            at = host.find(".", at) + 1
            if not at:
                break
        return best[2], best[3]


def tokens_of(host: str, path: str) -> list[str]:
    """What stands between separators in host and path, lower-cased; numbers are all one token."""
    return ["0" if w.isdigit() else w for w in PARTS.split(f"{host}/{path}".lower()) if w]


def pieces(token: str) -> list[str]:
    """A token cut where letters and digits meet; numbers are all one token."""
    return ["0" if w.isdigit() else w for w in DIGITS.findall(token)]


def standing(host: str, path: str) -> set[str]:
    """The tokens that stand as words: those of the path, and of host labels that separators split."""
    labels = [tokens_of(x, "") for x in host.split(".")]
    return {w for x in labels if len(x) > 1 for w in x} | set(tokens_of("", path))


@dataclass
class Model:
    """words: unigram counts, of `total` words; seen: the weighted counts of segmented tokens in blocked and allowed urls,
    and sums, those of all tokens there, rare ones too."""

    words: dict[str, float]
    seen: dict[str, tuple[float, float]] = field(default_factory=dict)
    total: float = 0.0
    sums: tuple[float, float] = (0.0, 0.0)
    longest: int = 24

    def __post_init__(self) -> None:
        self.total = self.total or sum(self.words.values()) or 1.0
        if not any(self.sums):
            self.sums = (sum(b for b, _ in self.seen.values()), sum(a for _, a in self.seen.values()))
        self.remembered = lru_cache(100_000)(self.split)

    def __getstate__(self) -> tuple:
        return self.words, self.seen, self.total, self.sums, self.longest

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def segment(self, token: str) -> tuple[str, ...]:
        """The likeliest words of a token of letters; what words don't cover, and other tokens, stay whole."""
        return self.remembered(token) if len(token) <= REMEMBERED else self.split(token)

    def split(self, token: str) -> tuple[str, ...]:
        if not token.isalpha():
            return (token,)
        best, back = [0.0], [0]
        for j in range(1, len(token) + 1):
            c, i = math.inf, 0
            for k in range(max(0, j - self.longest), j):
                if (n := self.words.get(token[k:j])) is not None and (own := best[k] + math.log(self.total / n)) < c:
                    c, i = own, k
            best.append(c)
            back.append(i)
        if math.isinf(best[-1]):
            return (token,)
        out, j = [], len(token)
        while j:
            out.append(token[back[j] : j])
            j = back[j]
        return tuple(reversed(out))

    def features(self, tokens: list[str]) -> list[str]:
        return [w for t in tokens for x in pieces(t) for w in self.segment(x)]

    def blocked(self, tokens: list[str]) -> float:
        """The probability of block, with both verdicts alike likely beforehand. Tokens that the model doesn't have tell
        nothing."""
        odds, more = 0.0, len(self.seen) + 1
        for w in self.features(tokens):
            if (n := self.seen.get(w)) is not None:
                odds += math.log((n[0] + 1) / (self.sums[0] + more)) - math.log((n[1] + 1) / (self.sums[1] + more))
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def words_in(html: str | None) -> list[str]:
    """Runs of letters in a page's text, lower-cased."""
    return TEXT_WORD.findall(TAG.sub(" ", html).lower()) if html else []


def fit(pages: DataFrame, rules: Rules, text: str | None = None, share: float = 1 / 250_000, least: int = 20) -> Model:
    """Counts over all urls, and over the texts of the pages in column `text` if there is one.

    Single letters aren't words. A verdict's counts weigh so that both verdicts have as many tokens. Null urls and texts count nothing; without urls that rules
    block and others that they allow, the model tells nothing.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stands, count = Counter(), Counter()
        for batch in batches:
            for i, url in enumerate(batch.column(0).to_pylist()):
                host, path = parts_of(url)
                verdict = rules(host, path)[1] or ""
                tokens = [t for t in tokens_of(host, path) if t not in rules.named]
                stands.update(w for w in standing(host, path) if len(w) > 1 and w.isalpha() and w not in rules.named)
                if verdict:
                    count.update((t, verdict) for t in tokens)
                if text and (html := batch.column(1)[i].as_py()):
                    stands.update(w for w in words_in(html) if len(w) > 1)
                if len(count) + len(stands) > 200_000:
                    yield told(stands, count)
                    stands, count = Counter(), Counter()
        yield told(stands, count)

    def told(stands: Counter, count: Counter) -> pa.RecordBatch:
        n, m = len(stands), len(count)
        columns = [[*stands, *(t for t, _ in count)], [*stands.values(), *[0] * m], *([*[0] * n, *(c if v == w else 0 for (_, v), c in count.items())] for w in ("block", "allow"))]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["token", "stands", "block", "allow"])

    own = pages.select("url", *([text] if text else []))
    counted = cut(own.mapInArrow(each, "token string, stands long, block long, allow long").groupBy("token").agg(*(F.sum(c).alias(c) for c in ("stands", "block", "allow"))))
    total = counted.agg(F.sum("stands")).first()[0] or 0
    words = {r["token"]: float(r["stands"]) for r in counted.where(F.col("stands") >= max(least, share * total)).select("token", "stands").collect()}
    model = Model(words, total=float(total))

    def segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list[int]] = {}
            for t, b, a in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for w in model.features([t]):
                    held = out.setdefault(w, [0, 0])
                    held[0] += b
                    held[1] += a
            yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), *(pa.array([x[i] for x in out.values()], pa.int64()) for i in (0, 1))], ["word", "block", "allow"])

    seen = counted.where("block + allow > 0").select("token", "block", "allow").mapInArrow(segmented, "word string, block long, allow long").groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
    seen = cut(seen)
    sums = seen.agg(F.coalesce(F.sum("block"), F.lit(0)), F.coalesce(F.sum("allow"), F.lit(0))).first()
    if not all(sums):
        return model
    rows = seen.where(F.col("block") + F.col("allow") >= max(least, share * sum(sums))).collect()
    weight = [min(sums) / x for x in sums]
    return Model(words, {r["word"]: (r["block"] * weight[0], r["allow"] * weight[1]) for r in rows}, float(total), (float(min(sums)),) * 2)


def judge(pages: DataFrame, rules: Rules, model: Model, least: float = 0.9) -> DataFrame:
    """page_id, host, path, rule, verdict and blocked (the model's probability) for each row of pages, rows that share a
    page_id too; none for an empty table.

    Without a rule, a page is blocked from a probability of `least`. A null url, or one without ://, has neither host nor
    path and is allowed. Urls of any length are read to their end.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for url in batch.column(1).to_pylist():
                host, path = parts_of(url)
                rule, verdict = rules(host, path)
                p = model.blocked([t for t in tokens_of(host, path) if t not in rules.named])
                for column, value in zip(out, (host, path, rule, verdict or ("block" if p >= least else "allow"), p), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.string()) for c in out[:4]), pa.array(out[4], pa.float64())], ["page_id", "host", "path", "rule", "verdict", "blocked"])

    return pages.select("page_id", "url").mapInArrow(each, "page_id long, host string, path string, rule string, verdict string, blocked double")
