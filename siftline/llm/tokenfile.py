"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is, in order: zstandard frames of little-endian unsigned 32-bit ids, each of whole documents (a long document
may fill several); a skippable frame with the document index (doc_id, number of ids); a skippable frame with the seek
table in the public seekable format: compressed size, size and XXH64's low 32 bits of each frame, then the number of
frames, a descriptor and the magic number. Any zstandard reader decompresses the whole; ours fetches from the table
the frames of the documents asked for and checks their sums.

Spark writes the files: a row of the text source holds all but the last four bytes of a file, and those four, the
magic number, are its line separator. So the files go through Spark's committer to any store that Spark can write, and
an executor that is lost leaves no half file behind.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from ..session import scratch
from .common import cut, equal_slices, parts, remove, slice_hashes

SKIP, TABLE, MAGIC = 0x184D2A50, 0x184D2A5E, b"\xb1\xea\x92\x8f"
#: Bytes of ids in a frame, and compressed bytes in a file, beyond which a new one begins.
FRAME, FILE = 1 << 18, 1 << 26
#: Marks a missing doc_id in the index.
NO_ID = -(1 << 63)

#: Bytes of letters in texts of common characters.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True
#: The names that Spark's text sink gives to files: the task's number, then the file's among the task's.
PART_FILE = re.compile(r"part-([0-9]+)-[^/]*-c([0-9]+)[^/]*$")
#: Bytes of text that are cut into chunks at a time.
PART = 1 << 20
#: Chunks that a worker keeps, of up to LONG bytes; beyond it those go that were not seen for longest.
KEPT, LONG = 600_000, 64


class Writer:
    """Builds the bytes of one file."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.size = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((NO_ID if doc_id is None else doc_id, len(ids) // 4))
        if self.held and self.held + len(ids) > FRAME:
            self.flush()
        for at in range(0, len(ids), FRAME):
            self.open.append(ids[at : at + FRAME])
            self.held += len(self.open[-1])
            if self.held >= FRAME:
                self.flush()

    def flush(self) -> None:
        if self.open:
            raw = b"".join(self.open)
            self.frames.append(self.packer.compress(raw))
            self.table.append((len(self.frames[-1]), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            self.size += len(self.frames[-1])
            self.open, self.held = [], 0

    def close(self) -> bytes:
        self.flush()
        raw = np.array(self.index, "<i8").T.tobytes()
        packed = struct.pack("<I", xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF) + self.packer.compress(raw)
        self.frames.append(struct.pack("<II", SKIP, len(packed)) + packed)
        self.table.append((len(self.frames[-1]), 0, 0))
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        self.frames.append(struct.pack("<II", TABLE, len(entries) + 9) + entries + struct.pack("<IB", len(self.table), 0x80) + MAGIC)
        return b"".join(self.frames)


class Reader:
    """Reads documents of one file; fetch(at, n) gets bytes, so that a caller may read ranges only."""

    def __init__(self, fetch: Callable[[int, int], bytes], size: int):
        self.fetch = fetch
        n, flags, magic = struct.unpack("<IB4s", fetch(size - 9, 9))
        if magic != MAGIC or not flags & 0x80:
            raise ValueError("no seek table")
        self.table = np.frombuffer(fetch(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.table[:, 0])))
        self.raw = np.concatenate(([0], np.cumsum(self.table[:, 1])))
        index = fetch(int(self.at[-2]) + 8, int(self.table[-1, 0]) - 8)
        told = zstandard.ZstdDecompressor().decompress(index[4:])
        if xxhash.xxh64_intdigest(told) & 0xFFFFFFFF != struct.unpack("<I", index[:4])[0]:
            raise ValueError("the document index doesn't match its checksum")
        self.doc_ids, self.counts = np.frombuffer(told, "<i8").reshape(2, -1)
        self.starts = np.concatenate(([0], np.cumsum(self.counts)))

    def frame(self, k: int) -> bytes:
        raw = zstandard.ZstdDecompressor().decompress(self.fetch(int(self.at[k]), int(self.table[k, 0])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} doesn't match its checksum")
        return raw

    def ids(self, i: int) -> np.ndarray:
        """Of the document at place i: only the frames that hold it are read."""
        a, b = 4 * int(self.starts[i]), 4 * int(self.starts[i + 1])
        if a == b:
            return np.empty(0, "<u4")
        first, last = int(np.searchsorted(self.raw, a, "right")) - 1, int(np.searchsorted(self.raw, b, "left"))
        raw = b"".join(self.frame(k) for k in range(first, last) if self.table[k, 1])
        return np.frombuffer(raw[a - int(self.raw[first]) : b - int(self.raw[first])], "<u4")

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        """Each document's id and the bytes of its ids, a frame at a time."""
        held, k = bytearray(), 0
        for d, n in zip(self.doc_ids.tolist(), self.counts.tolist(), strict=True):
            while len(held) < 4 * n:
                held += self.frame(k)
                k += 1
            yield None if d == NO_ID else d, bytes(held[: 4 * n])
            del held[: 4 * n]


def byte_letters() -> dict[int, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}


def spread(flat: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[at : at + size] of each, one behind the other."""
    place = np.cumsum(size, dtype=np.int64)
    return flat[np.repeat(at - place + size, size) + np.arange(place[-1] if len(place) else 0)]


class Fast:
    """The tokenizers library behind a bounded memory of chunks.

    A text of common characters is cut where the tokenizer's own pattern always cuts: after a letter run, and before it
    or the one blank in front of it; a space goes with the letters behind it, other blanks are chunks of their own. Chunks are found by 64-bit hashes, many texts at a time, so that each
    different one is looked up once, and compared byte by byte: what shares a hash but not its bytes with another is
    tokenized by itself. A letter run, one match of the pattern, goes straight to the library's merges; what is between
    goes through the whole tokenizer, and so do other texts.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        self.merges = self.own.model.tokenize
        self.letters = byte_letters()
        #: Known chunks, by hash: where their ids begin in `flat`, how many there are, the turn that saw them last, and
        #: where their bytes begin in `text` and how many there are.
        self.keys, self.at, self.size, self.seen = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.flat = np.empty(0, "<u4")
        self.text_at, self.long, self.text = np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(9, np.uint8)
        self.turn = 0

    def whole(self, text: str) -> bytes:
        return array("I", self.own.encode(text, add_special_tokens=False).ids).tobytes()

    def chunk(self, c: bytes) -> list[int]:
        if LETTERS[c[-1]]:
            return [t.id for t in self.merges(c.decode("latin-1").translate(self.letters))]
        return self.own.encode(c.decode(), add_special_tokens=False).ids if c != b"\0" else []

    def places(self, keys: np.ndarray, data: bytes, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, and where those of each chunk begin there and how many they are. keys are sorted and distinct."""
        near = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        taken = self.keys[near] == keys if len(self.keys) else np.zeros(len(keys), bool)
        known, long = taken.copy(), end - start
        own = np.flatnonzero(taken)
        fits = self.long[near[own]] == long[own]
        known[own[~fits]] = False
        own = own[fits]
        known[own] = equal_slices(raw, start[own], self.text, self.text_at[near[own]], long[own])
        # What stays known comes first, so that its ids are one piece.
        more = np.flatnonzero(~known)
        stays = ~taken[more] & (long[more] <= LONG)
        more = more[np.argsort(~stays, kind="stable")]
        found = [self.chunk(data[a:b]) for a, b in zip(start[more].tolist(), end[more].tolist(), strict=True)]
        at, size = np.empty(len(keys), np.int64), np.empty(len(keys), np.int32)
        at[known], size[known] = self.at[near[known]], self.size[near[known]]
        size[more] = list(map(len, found))
        at[more] = len(self.flat) + np.cumsum(size[more], dtype=np.int64) - size[more]
        flat = np.concatenate((self.flat, np.fromiter(chain.from_iterable(found), "<u4", int(size[more].sum(dtype=np.int64)))))
        self.turn += 1
        self.seen[near[known]] = self.turn
        more = more[: int(stays.sum())]
        self.flat = flat[: int(at[more[-1]] + size[more[-1]]) if len(more) else len(self.flat)]
        held = len(self.text) - 9
        text = spread(raw, start[more], long[more])
        self.text = np.concatenate((self.text[:held], text, np.zeros(9, np.uint8)))
        text_at = held + np.cumsum(long[more], dtype=np.int64) - long[more]
        order = np.argsort(every := np.concatenate((self.keys, keys[more])), kind="stable")
        new = ((self.at, at[more]), (self.size, size[more]), (self.seen, np.full(len(more), self.turn, np.int32)), (self.text_at, text_at), (self.long, long[more]))
        self.keys = every[order]
        self.at, self.size, self.seen, self.text_at, self.long = (np.concatenate(x)[order] for x in new)
        if len(self.keys) > KEPT:
            stay = np.argsort(-self.seen, kind="stable")[: KEPT // 2]
            stay.sort()
            self.keys, self.size, self.seen, self.long = self.keys[stay], self.size[stay], self.seen[stay], self.long[stay]
            self.flat = spread(self.flat, self.at[stay], self.size)
            self.at = np.cumsum(self.size, dtype=np.int64) - self.size
            self.text = np.concatenate((spread(self.text, self.text_at[stay], self.long), np.zeros(9, np.uint8)))
            self.text_at = np.cumsum(self.long, dtype=np.int64) - self.long
        return flat, at, size

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [bool(bpe.PLAIN.match(t)) for t in texts]
        some = iter(self._plain([t.encode() for t, p in zip(texts, plain, strict=True) if p]))
        return [next(some) if p else self.whole(t) for t, p in zip(texts, plain, strict=True)]

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        data = b"\0".join([*texts, b""])
        n = len(data)
        raw = np.zeros(n + 9, np.uint8)
        raw[:n] = np.frombuffer(data, np.uint8)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = LETTERS[raw[:n]]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begin, end = edges[::2], edges[1::2]
        stop = np.cumsum([len(t) + 1 for t in texts]) - 1
        cut = np.zeros(n + 1, bool)
        before = np.where(begin > 0, raw[begin - 1], 0)
        cut[begin - BLANKS[before]] = True
        cut[begin[before != 32]] = True
        cut[end] = cut[stop] = cut[stop + 1] = cut[0] = True
        start = np.flatnonzero(cut[:n])
        end = np.append(start[1:], n)
        keys, at, which = np.unique(slice_hashes(raw, start, end), return_index=True, return_inverse=True)
        # Texts with chunks that share a hash with others of this part but not their bytes are tokenized whole.
        same = at[which]
        fits = end - start == (end - start)[same]
        fits[fits] = equal_slices(raw, start[fits], raw, start[same[fits]], (end - start)[fits])
        alone = set(np.searchsorted(stop, start[~fits]).tolist())
        flat, first, size = self.places(keys, data, raw, start[at], end[at])
        own = size[which]
        raw_ids = spread(flat, first[which], own).tobytes()
        place = np.cumsum(own, dtype=np.int64)
        bounds = 4 * np.concatenate(([0], (place - own)[np.searchsorted(start, stop)]))
        return [self.whole(texts[i].decode()) if i in alone else raw_ids[a:b] for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))]


_fast: dict[str, Fast] = {}


def fast(path: str) -> Fast:
    if path not in _fast:
        _fast[path] = Fast(path)
    return _fast[path]


def write_tokens(df: DataFrame, path: str, to: str, end_id: int | None = 0, partitions: int | None = None) -> None:
    """Writes the ids of each row's text to the folder `to`, in ascending doc_id order (missing ids first).

    df has doc_id (integer) and text; further columns are ignored. A null text counts as empty. end_id follows each
    document's ids. The rows are dealt out by ranges of doc_id; each range gives one file or, beyond FILE bytes, more.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, w = fast(bpe.place(path)), Writer()
        out = lambda: pa.RecordBatch.from_arrays([pa.array([w.close()[:-4]], pa.binary())], ["value"])
        for batch in batches:
            docs, size = batch.column(0).to_pylist(), pa.compute.binary_length(batch.column(1)).fill_null(0).to_pylist()
            for a, b in parts(size, PART):
                for d, ids in zip(docs[a:b], coder.encode([t or "" for t in batch.column(1)[a:b].to_pylist()]), strict=True):
                    w.add(d, ids + end)
                    if w.size >= FILE:
                        yield out()
                        w = Writer()
        if w.index:
            yield out()

    dealt = df.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    rows = dealt.mapInArrow(files, "value binary").select(F.col("value").cast("string"))
    rows.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(to)


def from_files(spark: SparkSession, at: str, schema: str, told: Callable[[bytes], tuple], wanted: list[int] | None = None) -> DataFrame:
    """file, place, doc_id and what `told` makes of the bytes of the ids, by the rest of schema, of all documents or those
    wanted. For the wanted ones, only the frames that hold them are decompressed."""

    def docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = content.as_buffer()
                r = Reader(lambda a, n, raw=raw: raw.slice(a, n).to_pybytes(), raw.size)
                if wanted is None:
                    rows = ((i, d, ids) for i, (d, ids) in enumerate(r))
                else:
                    rows = ((i, int(r.doc_ids[i]), r.ids(i).tobytes()) for i in np.flatnonzero(np.isin(r.doc_ids, wanted)).tolist())
                held, size = [], 0
                for i, d, ids in rows:
                    held.append((name, i, d, *told(ids)))
                    size += len(ids)
                    if size > 1 << 23:
                        yield pack(held)
                        held, size = [], 0
                if held:
                    yield pack(held)

    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in f"file string, place long, doc_id long, {schema}".split(", ")), strict=True)

    def pack(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(at).select("path", "content")
    return files.mapInArrow(docs, f"file string, place long, doc_id long, {schema}")


def read_tokens(spark: SparkSession, at: str, wanted: list[int] | None = None) -> DataFrame:
    """file, place, doc_id, ids (the bytes of little-endian unsigned 32-bit integers) of all documents or those wanted."""
    return from_files(spark, at, "ids binary", lambda ids: (ids,), wanted)


def in_order(file: str) -> tuple[int, ...]:
    """The numbers of a file's range and of its place there. As text, part-100000 would come before part-99999."""
    return tuple(int(x) for x in PART_FILE.search(file).groups())


def digests(df: DataFrame, path: str, to: str | None = None) -> DataFrame:
    """Writes df's ids with an end id 0, reads the files back and returns doc_id, start, n_tokens, ids_crc32 from them."""
    spark = df.sparkSession
    at = to or scratch(spark, "tokens")
    write_tokens(df, path, at)

    rows = from_files(spark, at, "n_tokens long, ids_crc32 long", lambda ids: (len(ids) // 4, zlib.crc32(ids)))
    w = F.expr("sum(n_tokens) OVER (PARTITION BY file ORDER BY place) - n_tokens")
    rows = cut(rows.withColumn("inside", w))
    if to is None:
        remove(spark, at)
    # Files are as many as ranges of documents, not as documents: their totals come to the driver.
    totals = sorted(rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect(), key=lambda r: in_order(r["file"]))
    base, before = [], 0
    for r in totals:
        base.append((r["file"], before))
        before += r["n"]
    return rows.join(spark.createDataFrame(base, "file string, base long"), "file").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
