"""Substring dedup: words of passages that also start in an earlier document are removed.

1. Each window of k words has a minimizer, the least hash among its runs of a few words; windows that follow each other
   with one minimizer make a passage. Equal windows have equal minimizers, so a minimizer that stands in one document
   only can't belong to a repeated window.
2. Minimizers meet by their hashes. What a task finds in several of its documents itself needs no company: one of the
   entries tells the others, so that frequent ones are combined before they move.
3. Passages whose minimizers repeat go to shards by minimizer. Of the copies that a task sees, only that of the smallest
   doc_id goes; the others are repeats already. Minimizers that are frequent in a sample of documents are told further
   apart: a window that has the minimizer in its first half goes by the words behind it too, another by those before it,
   which equal windows share. The sample decides on where windows meet, not on whether they do.
4. A shard takes its passages in the order of their documents, a block at a time. Each block is streamed through the
   compressed FM-indexes (see fmindex) of the blocks before it: backward search gives matching statistics, cut off at k,
   and each match of k words is a repeat. What isn't all repeats is indexed and then streamed through its own block's
   index, where a match knows the first passage that has it; if that is of a smaller doc_id, the window is a repeat.
5. The spans of repeated windows meet their documents.

Entries travel packed, many in a row, in buckets: a bucket is what a task holds at a time, and there are as many as
shuffle partitions, or more if the texts of a bucket would exceed BUCKET bytes. A text moves twice, passages once. Nothing
is cut off: a window is found wherever it stands, and hashes only tell which windows to compare (64 bits of each word, all
words of each window).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, U64, Words, cut, mix, parts, runs, utf8
from .fmindex import Index

#: Words in the runs whose least hash is a window's minimizer.
GRAM = 5
#: Bytes of text that a task takes at a time, and bytes of text of a bucket.
PART, BUCKET = 1 << 23, 1 << 28
#: Words of a block of a shard's passages.
BLOCK = 1 << 22
#: One of so many documents is in the sample for frequent minimizers; frequent are those that fill so large a part of a
#: bucket, and stand there so often at least.
SAMPLE, SHARE, OFTEN = 64, 1 / 16, 64

ROWS = "bucket int, aim int, doc_id long, version long, text string, packed binary"


# Packed entries: columns of integers, each as differences, compressed together.
def pack(columns: list[np.ndarray], raw: bytes = b"") -> bytes:
    flat = [np.array([len(columns), len(columns[0])], "<i8").tobytes()]
    for c in columns:
        flat.append(np.diff(c, prepend=c.dtype.type(0)).astype(c.dtype).tobytes() if c.dtype.kind == "i" else c.tobytes())
        flat.append(c.dtype.str.encode())
    return zstandard.ZstdCompressor(level=1).compress(flat[0] + b"".join(x[-3:] for x in flat[2::2]) + b"".join(flat[1::2]) + raw)


def unpack(packed: bytes) -> tuple[list[np.ndarray], bytes]:
    flat = zstandard.ZstdDecompressor().decompress(packed)
    m, n = np.frombuffer(flat, "<i8", 2).tolist()
    at, out = 16 + 3 * m, []
    for i in range(m):
        kind = np.dtype(flat[16 + 3 * i : 19 + 3 * i].decode())
        c = np.frombuffer(flat, kind, n, at)
        out.append(np.cumsum(c, dtype=kind) if kind.kind == "i" else c)
        at += n * kind.itemsize
    return out, flat[at:]


def bucket_of(doc_ids: np.ndarray, buckets: int) -> np.ndarray:
    """What bucketed() gives Spark's rows: XXH64 with seed 42, as Spark takes it of a long."""
    p1, p2, p3, p4, p5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, n: (x << U64(n)) | (x >> U64(64 - n))
    with np.errstate(over="ignore"):
        h = (U64(42) + p5 + U64(8)) ^ (turn(doc_ids.astype(np.int64).view(U64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> U64(33))) * p2
        h = (h ^ (h >> U64(29))) * p3
        h ^= h >> U64(32)
    return np.mod(h.view(np.int64), buckets).astype(np.int32)


def bucketed(doc_id: F.Column, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


class Passages:
    """Passages of some texts: words first to last (included) of all words, the minimizer's place and hash."""

    def __init__(self, texts: list[bytes], k: int):
        self.words = w = Words(texts)
        m = min(GRAM, k)
        grams = runs(w.hash, m)
        low, at, wide = grams, np.arange(len(grams)), 1
        while wide < k - m + 1:
            by = min(wide, k - m + 1 - wide)
            less = low[by:] < low[:-by]
            low, at = np.where(less, low[by:], low[:-by]), np.where(less, at[by:], at[:-by])
            wide += by
        ok = np.zeros(len(low) + 1, bool)
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            ok[a : max(a, b - k + 1)] = True
        own = np.flatnonzero(ok[:-1])
        new = np.concatenate(([True], (at[own][1:] != at[own][:-1]) | (own[1:] != own[:-1] + 1))) if len(own) else np.empty(0, bool)
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(own))[: len(begin)] - 1
        self.first, self.last = own[begin], own[end] + k - 1
        self.place = at[self.first]
        self.key = grams[self.place]
        self.text = w.text_of(self.first)


def identity(words: np.ndarray, first: np.ndarray, last: np.ndarray, k: int) -> np.ndarray:
    """A hash of each passage: its first and its last window have all of its words."""
    with np.errstate(over="ignore"):
        h = np.full(len(first), GOLDEN)
        for at in (first, last - k + 1):
            for i in range(k):
                h = (h ^ words[at + i]) * U64(0xD6E8FEB86659FD93)
                h ^= h >> U64(32)
        return mix(h ^ (last - first).astype(U64))


def split(by: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """The places of each value of `by`, in order."""
    if not len(by):
        return []
    order = np.argsort(by, kind="stable")
    own = by[order]
    edges = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    return [(int(own[a]), order[a:b]) for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(own)], strict=True)]


Row = tuple[int, int, bytes]


def told(rows: list[Row]) -> pa.RecordBatch:
    n = len(rows)
    null = lambda t: pa.nulls(n, t)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), null(pa.int64()), null(pa.int64()), null(pa.string()), pa.array([r[2] for r in rows], pa.binary())], ["bucket", "aim", "doc_id", "version", "text", "packed"])


def home(docs: np.ndarray, columns: list[np.ndarray], buckets: int) -> Iterator[Row]:
    """Entries of documents, in rows on their way to the documents' buckets."""
    for b, i in split(bucket_of(docs, buckets)):
        i = i[np.argsort(docs[i], kind="stable")]
        yield b, b, pack([docs[i], *(c[i] for c in columns)])


def entries(k: int, buckets: int) -> Callable:
    """Step 1: each document's minimizers, in packed rows. aim is that of the document's bucket for those that are known
    to repeat, -1 for others."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch.column(1)), batch.column(0).to_numpy()
            for a, b in parts([len(t) for t in texts], PART):
                p = Passages(texts[a:b], k)
                doc = ids[a:b][p.text]
                place = (p.place - p.words.first[p.text]).astype("<i4")
                order = np.argsort(p.key, kind="stable")
                key, own = p.key[order], doc[order]
                starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, int)
                many = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts) if len(key) else np.empty(0, bool)
                size = np.diff(np.append(starts, len(key)))
                known = order[np.repeat(many, size)]
                rows = list(home(doc[known], [place[known]], buckets))
                # One entry speaks for all that are known; its place is -1.
                lone = np.sort(order[np.repeat(~many, size)])
                speaker = order[starts[many]]
                send = np.concatenate((lone, speaker))
                at = np.concatenate((place[lone], np.full(len(speaker), -1, "<i4")))
                h = p.key[send]
                for bucket, i in split(((h >> U64(40)) % U64(buckets)).astype(np.int32)):
                    x = send[i]
                    rows.append((bucket, -1, pack([(h[i] & U64(0xFFFFFFFF)).astype("<u4"), ((h[i] >> U64(32)) & U64(0xFF)).astype("|u1"), doc[x].astype("<i8"), at[i]])))
                yield told(rows)

    return each


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[Row]]]:
    """The rows of each bucket: those that end here (aim -1) and those on their way."""
    last, here, on = None, [], []
    for batch in batches:
        for b, aim, packed in zip(batch.column("bucket").to_pylist(), batch.column("aim").to_pylist(), batch.column("packed").to_pylist(), strict=True):
            if b != last:
                if here or on:
                    yield last, here, on
                last, here, on = b, [], []
            if aim < 0:
                here.append(packed)
            else:
                on.append((aim, aim, packed))
            if len(on) >= 256:
                yield last, [], on
                on = []
    if here or on:
        yield last, here, on


def repeating(buckets: int) -> Callable:
    """Step 2: the documents and places of minimizers that stand in several documents."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, here, on in by_bucket(batches):
            if on:
                yield told(on)
            if here:
                low, high, doc, place = (np.concatenate(c) for c in zip(*(unpack(x)[0] for x in here), strict=True))
                key = high.astype(U64) << U64(32) | low
                order = np.argsort(key, kind="stable")
                key, doc, place = key[order], doc[order], place[order]
                starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                many = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)) | (np.minimum.reduceat(place, starts) < 0)
                found = np.repeat(many, np.diff(np.append(starts, len(key)))) & (place >= 0)
                if found.any():
                    yield told(list(home(doc[found], [place[found]], buckets)))

    return each


def with_documents(batches: Iterator[pa.RecordBatch], empty: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], pa.Array, np.ndarray, list[bytes]]]:
    """The entries of a bucket's documents, sorted by document, with documents of the bucket, some at a time."""
    last, held, columns = None, [], None
    for batch in batches:
        buckets, packed = batch.column("bucket").to_numpy(), batch.column("packed").to_pylist()
        at = 0
        while at < len(buckets):
            end = at + int(np.searchsorted(buckets[at:], buckets[at], "right"))
            if buckets[at] != last:
                last, held, columns = buckets[at], [], None
            i = at
            while i < end and packed[i] is not None:
                held.append(packed[i])
                i += 1
            if i < end:
                if columns is None:
                    columns = [np.concatenate(c) for c in zip(*(unpack(x)[0] for x in held), strict=True)] if held else empty
                    order = np.argsort(columns[0], kind="stable")
                    columns, held = [c[order] for c in columns], []
                rows = batch.slice(i, end - i)
                texts = utf8(rows.column("text"))
                for a, b in parts([len(t) for t in texts], PART):
                    yield columns, rows.column("doc_id")[a:b], rows.column("version").to_numpy()[a:b], texts[a:b]
            at = end


def of_documents(columns: list[np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries belong to which of the documents: their numbers and, for each, its document's place in ids."""
    a, b = np.searchsorted(columns[0], ids, "left"), np.searchsorted(columns[0], ids, "right")
    n = b - a
    return np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum()), np.repeat(np.arange(len(ids)), n)


def frequent(named: DataFrame, k: int, least: int) -> tuple[np.ndarray, int]:
    """The frequent minimizers of a sample, sorted, and the buckets that the texts need, `least` at least.

    Frequent ones are at most buckets / SHARE. All tasks get them.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(0))
            for a, b in parts([len(t) for t in texts], PART):
                keys, n = np.unique(Passages(texts[a:b], k).key, return_counts=True)
                size = sum(map(len, texts[a:b]))
                yield pa.RecordBatch.from_arrays([pa.array([None, *keys.view(np.int64).tolist()], pa.int64()), pa.array([size, *n.tolist()], pa.int64())], ["key", "n"])

    sample = named.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SAMPLE)) == 0).select("text").mapInArrow(each, "key long, n long")
    counted = cut(sample.groupBy("key").agg(F.sum("n").alias("n")))
    size, total = counted.agg(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.sum(F.when(F.col("key").isNotNull(), F.col("n")))).first()
    buckets = max(least, (size or 0) * SAMPLE // BUCKET)
    rows = counted.where(F.col("key").isNotNull() & (F.col("n") >= max(OFTEN, SHARE * (total or 0) / buckets))).select("key").collect()
    return np.sort(np.array([r["key"] for r in rows], np.int64).view(U64)), buckets


def apart(p: Passages, own: np.ndarray, hot: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """first, last, key and text of the passages `own`; those of hot minimizers in up to two parts, with keys of their own."""
    first, last, key, place, text = (x[own] for x in (p.first, p.last, p.key, p.place, p.text))
    often = hot[np.minimum(np.searchsorted(hot, key), len(hot) - 1)] == key if len(hot) else np.zeros(len(own), bool)
    if not often.any():
        return first, last, key, text
    m = min(GRAM, k)
    half = (k - m) // 2
    # Windows from here on have the minimizer `half` words or fewer behind their first word.
    border = place - half
    a, b, rest = np.flatnonzero(often & (last - k + 1 >= border)), np.flatnonzero(often & (first < border)), np.flatnonzero(~often)

    def wider(key: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            for i in range(n):
                key = (key ^ p.words.hash[at + i]) * U64(0xD6E8FEB86659FD93)
                key ^= key >> U64(32)
        return mix(key)

    keys = key[rest], wider(key[a] ^ GOLDEN, place[a] + m, k - m - half), wider(~key[b], place[b] - half - 1, half + 1)
    return np.concatenate((first[rest], np.maximum(first, border)[a], first[b])), np.concatenate((last[rest], last[a], np.minimum(last, border + k - 2)[b])), np.concatenate(keys), np.concatenate((text[rest], text[a], text[b]))


def passages(k: int, buckets: int, hot: np.ndarray) -> Callable:
    """Step 3: passages with repeating minimizers to their shards, and spans that are repeats already to documents."""
    empty = [np.empty(0, np.int64), np.empty(0, "<i4")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, own_ids, versions, texts in with_documents(batches, empty):
            ids = own_ids.to_numpy()
            entry, of = of_documents(columns, ids)
            wanted = np.unique(of)
            if not len(wanted):
                continue
            p = Passages([texts[i] for i in wanted.tolist()], k)
            some = np.zeros(len(p.words.hash) + 1, bool)
            # Rows that share a doc_id may differ in length; such a place may lie outside.
            at = p.words.first[np.searchsorted(wanted, of)] + columns[1][entry]
            some[at[at < len(some)]] = True
            own = np.flatnonzero(some[p.place])
            if not len(own):
                continue
            first, last, key, text = apart(p, own, hot, k)
            doc, version = ids[wanted][text], versions[wanted][text]
            begin = p.words.first[text]
            same = identity(p.words.hash, first, last, k)
            order = np.lexsort((doc, same))
            least = np.empty(len(first), np.int64)
            starts = np.flatnonzero(np.concatenate(([True], same[order][1:] != same[order][:-1])))
            least[order] = np.repeat(doc[order][starts], np.diff(np.append(starts, len(first))))
            again = np.flatnonzero(doc > least)
            rows = list(home(doc[again], [version[again], (first - begin)[again].astype("<i4"), (last - first + 1)[again].astype("<i4")], buckets))
            go = np.flatnonzero(doc == least)
            data, start, end = p.words.data, p.words.start, p.words.end
            for bucket, i in split(((key[go] >> U64(40)) % U64(buckets)).astype(np.int32)):
                i = go[i]
                raw = b" ".join([data[a:b] for a, b in zip(start[first[i]].tolist(), end[last[i]].tolist(), strict=True)])
                rows.append((bucket, -1, pack([doc[i].astype("<i8"), version[i].astype("<i8"), (first - begin)[i].astype("<i4"), (last - first + 1)[i].astype("<i4")], raw)))
            yield told(rows)

    return each


def repeats(doc: np.ndarray, first: np.ndarray, size: np.ndarray, words: np.ndarray, k: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Step 4: which windows of the distinct passages words[first : first + size], in ascending order of doc, are repeats:
    the passage and the place in it."""
    who, place = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    indexes: list[Index] = []
    # A block ends with a document.
    ends = np.flatnonzero(np.append(doc[1:] != doc[:-1], True))
    ends = ends[np.flatnonzero(np.diff(np.append(np.cumsum(size)[ends] // block, -1)))] + 1
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
        own, known = np.arange(a, b), np.zeros(b - a, np.int64)
        held = []
        for index in indexes:
            w, at, _ = index.search(words, first[own], size[own])
            held.append(w * (1 << 32) + at)
        if held:
            held = np.unique(np.concatenate(held))
            who.append(own[held >> 32])
            place.append(held & 0xFFFFFFFF)
            known = np.bincount(held >> 32, minlength=b - a)
        own = own[known < size[own] - k + 1]
        if len(own):
            n = size[own]
            flat = words[np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            index = Index(flat, n, k)
            w, at, earlier = index.search(flat, np.cumsum(n) - n, n)
            hit = doc[own][earlier] < doc[own][w]
            who.append(own[w[hit]])
            place.append(at[hit])
            if b < len(doc):
                indexes.append(index)
    return np.concatenate(who), np.concatenate(place)


def indexed(k: int, buckets: int, block: int) -> Callable:
    """Step 4: the spans of a shard's passages that are repeats."""

    def spans(doc: np.ndarray, version: np.ndarray, at: np.ndarray, size: np.ndarray, words: np.ndarray) -> Iterator[Row]:
        first = np.cumsum(size) - size
        same = identity(words, first, first + size - 1, k)
        order = np.lexsort((doc, same))
        starts = np.flatnonzero(np.concatenate(([True], same[order][1:] != same[order][:-1])))
        one = order[starts]  # of each distinct passage the copy of the smallest doc_id
        by_doc = np.argsort(doc[one], kind="stable")
        rank = np.empty(len(one), np.int64)
        rank[by_doc] = np.arange(len(one))
        one, group = one[by_doc], np.empty(len(doc), np.int64)
        group[order] = rank[np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(doc))))]
        later = np.flatnonzero(doc > doc[one][group])
        found = [(doc[later], version[later], at[later], size[later])]
        who, place = repeats(doc[one], first[one], size[one].astype(np.int64), words, k, block)
        order = np.lexsort((place, who))
        who, place = who[order], place[order]
        new = np.concatenate(([True], (who[1:] != who[:-1]) | (place[1:] != place[:-1]))) if len(who) else np.empty(0, bool)
        who, place = who[new], place[new]
        joined = np.concatenate(([True], (who[1:] != who[:-1]) | (place[1:] != place[:-1] + 1))) if len(who) else np.empty(0, bool)
        a = np.flatnonzero(joined)
        b = np.append(a[1:], len(who))[: len(a)] - 1
        who, place, long = who[a], place[a], place[b] - place[a] + k
        # Copies in the document of the smallest doc_id itself share what the search has found.
        copies = np.flatnonzero(doc == doc[one][group])
        copies = copies[np.argsort(group[copies], kind="stable")]
        lo, hi = np.searchsorted(group[copies], who, "left"), np.searchsorted(group[copies], who, "right")
        n = hi - lo
        copy = copies[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
        found.append((doc[copy], version[copy], (at[copy] + np.repeat(place, n)).astype("<i4"), np.repeat(long, n).astype("<i4")))
        doc, version, at, size = (np.concatenate(c) for c in zip(*found, strict=True))
        yield from home(doc, [version, at.astype("<i4"), size.astype("<i4")], buckets)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, here, on in by_bucket(batches):
            if on:
                yield told(on)
            if here:
                columns, raw = zip(*map(unpack, here), strict=True)
                rows = list(spans(*(np.concatenate(c) for c in zip(*columns, strict=True)), Words(list(raw)).hash))
                if rows:
                    yield told(rows)

    return each


def add_spans(docs: DataFrame, finish: Callable, schema: str, k: int = 13) -> DataFrame:
    """finish(ids, texts, covered) for some documents at a time, where covered tells for each the repeated words.

    A word is repeated where a window of k consecutive words covers it that also starts in a document of a smaller
    doc_id. finish gives a record batch of the columns of `schema`. A null text counts as empty. Rows without doc_id
    neither lose words nor make others lose some. Rows that share a doc_id are one document. Further columns of docs are
    ignored.
    """
    own = docs.select(F.col("doc_id").cast("long"), "text")
    named = own.where("doc_id IS NOT NULL AND text IS NOT NULL")
    hot, buckets = frequent(named, k, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def meet(rows: DataFrame, *by: F.Column | str) -> DataFrame:
        return rows.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", *by)

    def joined(rows: DataFrame, texts: DataFrame) -> DataFrame:
        texts = texts.select(F.coalesce(bucketed(F.col("doc_id"), buckets), F.lit(0)).alias("bucket"), F.lit(None).cast("int").alias("aim"), "doc_id", F.xxhash64("text").alias("version"), "text", F.lit(None).cast("binary").alias("packed"))
        # A bucket's packed rows come first; documents come in a set order, so that a second attempt gives the same rows.
        return meet(rows.unionByName(texts), F.col("packed").isNull(), "doc_id", "version")

    known = meet(named.mapInArrow(entries(k, buckets), ROWS)).mapInArrow(repeating(buckets), ROWS)
    moved = joined(known, named).mapInArrow(passages(k, buckets, hot), ROWS)
    spans = cut(meet(moved).mapInArrow(indexed(k, buckets, BLOCK), ROWS))
    empty = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<i4"), np.empty(0, "<i4")]

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, ids, versions, texts in with_documents(batches, empty):
            real = ids.is_valid().to_numpy(zero_copy_only=False)
            entry, of = of_documents(columns, ids.fill_null(0).to_numpy())
            ok = (columns[1][entry] == versions[of]) & real[of]
            covered: list[list[tuple[int, int]]] = [[] for _ in texts]
            for i, a, n in zip(of[ok].tolist(), columns[2][entry][ok].tolist(), columns[3][entry][ok].tolist(), strict=True):
                covered[i].append((a, a + n))
            yield finish(ids, texts, covered)

    return joined(spans, own).mapInArrow(last, schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    at, out = 0, []
    for a, b in merged(spans):
        out += words[at:a]
        at = b
    return out + words[at:]


def repeated_spans(docs: DataFrame, k: int = 13) -> DataFrame:
    """doc_id and spans (first word, from 0, and first word behind it) of the words that repeat, a row for each of docs'.

    See add_spans for odd rows; a text without repeats has no spans.
    """

    def finish(ids: pa.Array, texts: list[bytes], covered: list) -> pa.RecordBatch:
        spans = [[{"begin": a, "end": b} for a, b in merged(c)] for c in covered]
        return pa.RecordBatch.from_arrays([ids, pa.array(spans, pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))], ["doc_id", "spans"])

    return add_spans(docs, finish, "doc_id long, spans array<struct<begin: int, end: int>>", k)


def digests(docs: DataFrame, k: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by spaces), a row for each of docs'."""

    def finish(ids: pa.Array, texts: list[bytes], covered: list) -> pa.RecordBatch:
        n, lost, sums = [], [], []
        for text, spans in zip(texts, covered, strict=True):
            words = text.split()
            kept = without(words, spans) if spans else words
            n.append(len(words))
            lost.append(len(words) - len(kept))
            sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(sums)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return add_spans(docs, finish, "doc_id long, n_words long, n_removed long, kept_sha256 string", k)
