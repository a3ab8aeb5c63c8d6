"""Benchmark decontamination: rare n-gram seeds find passages, Smith-Waterman alignment scores them against test items.

1. Words are runs of letters and digits, A-Z lower-cased. The items' n-grams are counted over all documents. Those of
   an item that are rare beside its others, up to RARER times the median of its own, are its rare seeds. The others may
   be stock phrases or the intact part of an edited copy that many documents share, which counts can't tell apart.
2. A document that holds a seed is aligned with the seed's item around it: a match gains 1, a mismatch or a gap costs 1,
   and the best local score over the item's number of words is the score. A whole copy has 1.0; a copy in which every
   fifth word is another has 0.6. Around seeds none of which is rare, what has too few of the item's words to reach the
   bound isn't aligned: a score is at most the number of matches, so no pair is lost to a seed's frequency.

A copy without n consecutive words in common with its item has no seed and isn't found. With n = 3 and a bound of 0.5
that can't happen by replaced and left-out words: if x of an item's L words are so, the score is (L - 2x) / L at most, x
is L / 4 at most, and of the x + 1 runs that are left one has 3 words or more wherever L is over 8. Only words put in,
which cost 1 and no match, can do it: one after every second word of the item. A seed alone is no finding: local scores
under FEWEST count as none, so that a phrase doesn't stand for a short item.

Items are few beside documents: a stated query set, held against all documents in blocks of at most BLOCK words, each of
which is small enough for every task. Documents don't move between executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, Words, cut, lean, parts, runs, utf8

N = 3
#: The least local score, in words, that counts for short items too.
FEWEST = 4
RARER, FLOOR = 4, 20
#: Words of the items in a block, and bytes of documents that a task takes at a time.
BLOCK, PART = 1 << 20, 1 << 22
#: Seeds of an item whose diagonals differ by up to this many words are aligned together.
NEAR = 32
#: Pairs that are aligned at a time, and cells in a row of all of them, beyond one pair.
LANES, CELLS = 512, 1 << 20

INSIDE = np.zeros(256, bool)
INSIDE[[*b"0123456789", *range(65, 91), *range(97, 123), *range(128, 256)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def words(texts: list[bytes]) -> Words:
    return Words(texts, INSIDE, FOLD)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words of one text, and the place of each one's first word among all."""
    every = runs(w.hash, n)
    ok = np.zeros(len(every), bool)
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        ok[a : max(a, b - n + 1)] = True
    at = np.flatnonzero(ok)
    return every[at], at


@dataclass
class Items:
    """The items of a block: their ids and words; and their seeds, sorted, each with its item, its place there and whether it is rare."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    few: np.ndarray

    @classmethod
    def of(cls, ids: list, texts: list[str | None], n: int) -> Items:
        w = words([(t or "").encode("utf-8", "surrogatepass") for t in texts])
        hashes, at = grams(w, n)
        item = w.text_of(at)
        order = np.argsort(hashes, kind="stable")
        return cls(ids, [w.hash[a:b] for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)], hashes[order], item[order], (at - w.first[item])[order], np.ones(len(order), bool))

    def rare(self, seen: np.ndarray) -> Items:
        """seen: in how many documents each seed is. Seeds of no document go."""
        ok = np.zeros(len(self.seeds), bool)
        for i in range(len(self.ids)):
            own = np.flatnonzero(self.item == i) if len(self.ids) < 64 else self._own(i)
            if len(own):
                ok[own] = seen[own] <= max(FLOOR, RARER * float(np.median(seen[own])))
        held = seen > 0
        return Items(self.ids, self.words, self.seeds[held], self.item[held], self.place[held], ok[held])

    def _own(self, i: int) -> np.ndarray:
        if not hasattr(self, "_by_item"):
            order = np.argsort(self.item, kind="stable")
            edges = np.searchsorted(self.item[order], np.arange(len(self.ids) + 1))
            self._by_item = [order[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return self._by_item[i]

    def hits(self, w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places among all words and numbers of seeds; where items share a seed, each one's."""
        hashes, at = grams(w, n)
        a = np.searchsorted(self.seeds, hashes, "left")
        ok = np.flatnonzero((a < len(self.seeds)) & (self.seeds[np.minimum(a, len(self.seeds) - 1)] == hashes)) if len(self.seeds) else np.empty(0, np.int64)
        a = a[ok]
        n_same = np.searchsorted(self.seeds, hashes[ok], "right") - a
        return np.repeat(at[ok], n_same), np.repeat(a - np.cumsum(n_same) + n_same, n_same) + np.arange(n_same.sum())


def align(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The best local score of each pair of word sequences; many pairs advance together, a word of the first at a time."""
    out = np.zeros(len(a), np.int64)
    order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
    at = 0
    while at < len(order):
        lanes, wide = [], 0
        for i in order[at : at + LANES]:
            wide = max(wide, len(a[i]), len(b[i]) + 1)
            if lanes and wide * (len(lanes) + 1) > CELLS:
                break
            lanes.append(i)
        at += len(lanes)
        x = np.zeros((len(lanes), max(len(a[i]) for i in lanes)), U64)
        y = np.zeros((len(lanes), max(len(b[i]) for i in lanes)), U64)
        inside = np.zeros(x.shape, bool)
        known = np.zeros(y.shape, bool)
        for r, i in enumerate(lanes):
            x[r, : len(a[i])], inside[r, : len(a[i])] = a[i], True
            y[r, : len(b[i])], known[r, : len(b[i])] = b[i], True
        slope = np.arange(y.shape[1] + 1)
        h = np.zeros((len(lanes), y.shape[1] + 1), np.int64)
        best = np.zeros(len(lanes), np.int64)
        for j in range(x.shape[1]):
            same = (y == x[:, j : j + 1]) & known & inside[:, j : j + 1]
            new = np.maximum(h - 1, 0)
            new[:, 1:] = np.maximum(new[:, 1:], h[:, :-1] + np.where(same, 1, -1))
            h = np.maximum.accumulate(new + slope, axis=1) - slope  # gaps in the first
            best = np.maximum(best, h.max(axis=1))
        out[lanes] = best
    return out


def aligned(items: Items, w: Words, n: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all pairs that share a seed and can score `least`: the text, the item's number and the score."""
    at, seed = items.hits(w, n)
    none = np.empty(0, np.int64)
    if not len(at):
        return none, none, np.empty(0)
    text, item = w.text_of(at), items.item[seed]
    diagonal = at - items.place[seed]
    order = np.lexsort((diagonal, item, text))
    text, item, diagonal, few = text[order], item[order], diagonal[order], items.few[seed[order]]
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > NEAR)))
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(text)) - 1
    text, item, lo, hi, few = text[start], item[start], diagonal[start], diagonal[end], np.logical_or.reduceat(few, start)
    a, b, able = [], [], np.ones(len(text), bool)
    for k, (t, i, x, y, rare) in enumerate(zip(text.tolist(), item.tolist(), lo.tolist(), hi.tolist(), few.tolist(), strict=True)):
        own = items.words[i]
        more = int((1 - least) * len(own)) + n  # with more words left out or put in, an alignment is under the bound
        around = w.hash[max(int(w.first[t]), x - more) : min(int(w.first[t + 1]), y + len(own) + more)]
        if not rare and np.isin(own, around).sum() < least * len(own):
            able[k] = False
            continue
        a.append(own)
        b.append(around)
    text, item = text[able], item[able]
    if not len(text):
        return none, none, np.empty(0)
    found = align(a, b)
    score = np.where(found >= FEWEST, found, 0) / np.array([len(x) for x in a])
    order = np.lexsort((score, item, text))
    last = np.concatenate(((text[order][1:] != text[order][:-1]) | (item[order][1:] != item[order][:-1]), [True]))
    own = order[last]
    return text[own], item[own], score[own]


def blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list]:
    """Rows (id, text) of the items, some at a time, each block of about BLOCK words."""
    own = items.where(F.col(text).isNotNull() & F.col(item_id).isNotNull()).select(F.col(item_id).alias("id"), F.col(text).alias("text"))
    n = int(own.agg(F.coalesce(F.sum(F.length("text") / 4 + 1), F.lit(0))).first()[0])
    many = 1 + n // BLOCK
    for i in range(many):
        some = own.where(F.pmod(F.xxhash64("id"), F.lit(many)) == i)
        yield sorted(some.collect(), key=lambda r: (r["id"], r["text"]))


def rare_items(docs: DataFrame, items: DataFrame, n: int) -> Iterator[Items]:
    """The items with the seeds that documents hold, told rare or not, a block at a time."""
    for rows in blocks(items, "item_id", "text"):
        every = Items.of([r["id"] for r in rows], [r["text"] for r in rows], n)

        @lean("decontam")
        def counted(batches: Iterator[pa.RecordBatch], every: Items = every) -> Iterator[pa.RecordBatch]:
            seen = np.zeros(len(every.seeds), np.int64)
            for batch in batches:
                texts = utf8(batch.column(0))
                for a, b in parts([len(t) for t in texts], PART):
                    w = words(texts[a:b])
                    at, seed = every.hits(w, n)
                    own = np.unique(w.text_of(at) * len(every.seeds) + seed) % max(1, len(every.seeds))
                    seen += np.bincount(own, minlength=len(every.seeds))
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen)), pa.array(seen[seen > 0])], ["seed", "n"])

        seen = np.zeros(len(every.seeds), np.int64)
        for r in docs.select("text").mapInArrow(counted, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n")).collect():
            seen[r["seed"]] = r["n"]
        yield every.rare(seen)


def pairs(docs: DataFrame, items: DataFrame, n: int = N, least: float = 0.5) -> DataFrame:
    """doc_id, item_id and score of the pairs whose score is `least` or more.

    docs has doc_id and text, items item_id and text. Items of fewer than FEWEST words match nothing, nor do null texts.
    Rows that share a doc_id are one document with the best score of them. Rows without doc_id match with a null one.
    """
    found = None
    for rare in rare_items(docs, items, n):

        @lean("decontam")
        def scored(batches: Iterator[pa.RecordBatch], rare: Items = rare) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = utf8(batch.column(1))
                for a, b in parts([len(t) for t in texts], PART):
                    text, item, score = aligned(rare, words(texts[a:b]), n, least)
                    ok = score >= least
                    ids = batch.column(0)[a:b].take(pa.array(text[ok]))
                    yield pa.RecordBatch.from_arrays([ids, pa.array([rare.ids[i] for i in item[ok].tolist()], pa.int64()), pa.array(score[ok], pa.float64())], ["doc_id", "item_id", "score"])

        own = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scored, "doc_id long, item_id long, score double")
        found = own if found is None else found.unionByName(own)
    return found.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def judge(docs: DataFrame, items: DataFrame, n: int = N, least: float = 0.5) -> DataFrame:
    """doc_id, contaminated, item_id (of the best score, then the smallest), score, n_items and kept, a row for each
    doc_id of docs' (each row without one counts by itself and is kept). See pairs for odd rows."""
    best = cut(pairs(docs, items, n, least)).groupBy("doc_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "item_id")).alias("x"), F.count(F.lit(1)).alias("n"))
    best = best.select(F.col("doc_id").alias("__of"), F.col("x.item_id").alias("item_id"), (-F.col("x.s")).alias("score"), F.col("n").alias("n_items"))
    out = docs.select(F.col("doc_id").cast("long")).join(best, F.col("doc_id") == F.col("__of"), "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), "item_id", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.col("n_items").isNull().alias("kept"))


def clean(docs: DataFrame, items: DataFrame, n: int = N, least: float = 0.5) -> DataFrame:
    """The rows of docs, with all columns, whose texts score under `least` with all items. Nothing is shuffled."""
    at, out = docs.columns.index("text"), docs
    for rare in rare_items(docs, items, n):

        @lean("decontam")
        def kept(batches: Iterator[pa.RecordBatch], rare: Items = rare) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, ok = utf8(batch.column(at)), np.ones(len(batch), bool)
                for a, b in parts([len(t) for t in texts], PART):
                    text, _, score = aligned(rare, words(texts[a:b]), n, least)
                    ok[a + text[score >= least]] = False
                yield batch.filter(pa.array(ok))

        out = out.mapInArrow(kept, docs.schema)
    return out
