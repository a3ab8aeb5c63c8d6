"""Quality rules: counts of each text, and an ordered list of threshold conjunctions learned from labels.

All of it is column expressions: the counts are taken within a row, so no text moves between executors, and the
learned list is a chain of conditionals. Only the learning itself, over a bounded sample of labelled counts, is done on
the driver, in plain Python and numpy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAK = "[ \\t-\\r]+"
#: What the counts are compared by.
FEATURES = ("n_words", "mean_word", "symbols_per_word", "dup_lines_per_word", "repeats_per_word", "upper_share", "bangs_per_word", "distinct_share")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is worked out once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def repeated(words: Column, k: int = 5) -> Column:
    """How many words stand in windows of k that occur twice or more.

    First by hashes: with as many distinct ones as windows nothing repeats, and equal windows have equal hashes. Only
    the other texts compare the windows themselves.
    """

    def starts(w: Column) -> Column:
        return F.sequence(F.lit(1), F.size(w) - (k - 1))

    def covered(w: Column) -> Column:
        def over(s: Column) -> Column:  # windows in order, each with its start
            same = lambda i, j: F.get(s, i)["w"] == F.get(s, j)["w"]
            last = F.size(s) - 1
            twice = F.filter(F.sequence(F.lit(0), last), lambda i: ((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)))
            at = F.array_sort(F.transform(twice, lambda i: F.get(s, i)["i"]))
            step = lambda d: F.aggregate(F.sequence(F.lit(0), F.size(d) - 1), F.lit(0), lambda n, i: n + F.coalesce(F.least(F.get(d, i + 1) - F.get(d, i), F.lit(k)), F.lit(k)))
            return let(at, lambda d: F.when(F.size(d) > 0, step(d)).otherwise(0))

        return let(F.array_sort(F.transform(starts(w), lambda i: F.struct(F.array_join(F.slice(w, i, k), " ").alias("w"), i.alias("i")))), over)

    def each(w: Column) -> Column:
        hashes = F.transform(starts(w), lambda i: F.xxhash64(*(F.get(w, i + j - 1) for j in range(k))))
        return F.when(F.size(w) < k, 0).when(let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), 0).otherwise(covered(w))

    return let(words, each)


def counts(df: DataFrame) -> DataFrame:
    """doc_id and the counts of each text; a null text counts as empty, with all counts 0.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words as their names say, and n_upper (A-Z),
    n_bangs and n_distinct (different words), which the learned rules use besides. A row for each of df's.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    longer = lambda c, pattern: (F.length(c) - F.length(F.regexp_replace(c, pattern, ""))).cast("long")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    w = df.select("doc_id", t.alias("t"), words_of(t).alias("w"))
    return w.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        longer(F.col("t"), "[#*$%&|<>]+").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated(F.col("w")).cast("long").alias("n_repeat_words"),
        longer(F.col("t"), "[A-Z]+").alias("n_upper"),
        longer(F.col("t"), "!+").alias("n_bangs"),
        F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
    )


def features() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines_per_word": F.col("n_dup_lines") / words,
        "repeats_per_word": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "bangs_per_word": F.col("n_bangs") / words,
        "distinct_share": F.col("n_distinct") / words,
    }


@dataclass(frozen=True)
class Test:
    feature: int
    above: bool
    limit: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.feature] >= self.limit if self.above else x[:, self.feature] < self.limit

    def column(self, of: dict[str, Column]) -> Column:
        c = of[FEATURES[self.feature]]
        return c >= F.lit(self.limit) if self.above else c < F.lit(self.limit)


Rule = tuple[Test, ...]


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= t(x)
    return out


def grow(x: np.ndarray, bad: np.ndarray, most: int = 4, cuts: int = 64) -> Rule:
    """Adds the test of most information gained until the rule holds for no good row or nothing is gained."""
    rule: Rule = ()
    inside = np.ones(len(x), bool)
    while len(rule) < most:
        p, n = int((inside & bad).sum()), int((inside & ~bad).sum())
        if not p or not n:
            break
        best, test, now = 1e-9, None, np.log2(p / (p + n))
        for f in range(x.shape[1]):
            own = x[inside, f]
            values = np.unique(own)
            if len(values) < 2:
                continue
            at = values[np.unique(np.linspace(0, len(values) - 2, min(cuts, len(values) - 1)).astype(int))]
            limits = np.array([(v + values[np.searchsorted(values, v, "right")]) / 2 for v in at])
            order = np.sort(own)
            hit = np.sort(own[bad[inside]])
            all_below, bad_below = np.searchsorted(order, limits), np.searchsorted(hit, limits)
            for above, q, m in ((True, p - bad_below, p + n - all_below), (False, bad_below, all_below)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(q > 0, q * (np.log2(q / m) - now), 0)
                if gain.max() > best:
                    best, test = float(gain.max()), Test(f, above, float(limits[gain.argmax()]))
        if test is None:
            break
        rule += (test,)
        inside &= test(x)
    return rule


def prune(rule: Rule, x: np.ndarray, bad: np.ndarray) -> Rule:
    """The leading tests that tell bad from good best on rows the rule has not grown on."""

    def worth(r: Rule) -> float:
        h = holds(r, x)
        p, n = int((h & bad).sum()), int((h & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:i] for i in range(len(rule), 0, -1)), key=worth, default=())


def learn(x: np.ndarray, bad: np.ndarray, precise: float = 0.9, seed: int = 7, most: int = 12) -> list[Rule]:
    """Sequential covering: rules for bad rows, each grown on two thirds of what is left and pruned on the rest.

    It stops where a rule is right for fewer than `precise` of what it covers in either part, or covers nothing.
    """
    rng, out = np.random.default_rng(seed), []
    left = np.ones(len(x), bool)
    while len(out) < most and (left & bad).any():
        own = np.flatnonzero(left)
        rng.shuffle(own)
        a, b = own[: 2 * len(own) // 3], own[2 * len(own) // 3 :]
        rule = prune(grow(x[a], bad[a]), x[b], bad[b])
        h = holds(rule, x) & left
        right = [(h[i] & bad[i]).sum() >= precise * max(1, h[i].sum()) for i in (a, b)]
        if not rule or not all(right):
            break
        out.append(rule)
        left &= ~h
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = 6000) -> list[Rule]:
    """Learns from the counts of about `sample` labelled documents, chosen by a hash of doc_id; label 0 is bad.

    A document with several labels takes the least; labels without quality or document are left out. Without any bad
    or any good ones there are no rules.
    """
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = max(1, labels.count())
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, sample / n) * (1 << 20))
    stats = counts(docs.where(share)).select("doc_id", *(c.alias(k) for k, c in features().items()))
    rows = stats.join(known.where(share), "doc_id").collect()
    if not rows:
        return []
    rows.sort(key=tuple)
    x = np.array([[r[f] for f in FEATURES] for r in rows], float)
    return learn(x, np.array([r["quality"] == 0 for r in rows]))


def verdict(rules: list[Rule]) -> Column:
    """False for what the first rule that holds rejects; the list has no rule that keeps, so the rest is kept."""
    of, out = features(), None
    for rule in rules:
        hit = rule[0].column(of)
        for t in rule[1:]:
            hit = hit & t.column(of)
        out = F.when(hit, False) if out is None else out.when(hit, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The counts with base_failed (under 10 words, or over a fifth of them repeated) and kept.

    A row for each of docs', rows that share a doc_id or have none too; no rows of no rows. A null or empty text has no
    words and fails. Only doc_id and text are read, whatever other columns are named; texts count to their end.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return counts(docs).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
