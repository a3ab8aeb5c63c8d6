"""What several operators share: lineage cuts, what workers keep, words and mixing functions."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

U64 = np.uint64
GOLDEN = U64(0x9E3779B97F4A7C15)

#: Rows of a batch whose texts are Python's objects at a time.
SLICE = 256
#: What this worker process keeps from task to task, by operator.
KEPT: dict[str, dict] = {}
#: Hands what is freed back to the system; only some C libraries have it.
TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def kept(operator: str) -> dict:
    return KEPT.setdefault(operator, {})


def drop_others(operator: str) -> None:
    for other in KEPT.keys() - {operator}:
        del KEPT[other]


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    if TRIM:
        TRIM(0)


def lean(operator: str) -> Callable[[Callable], Callable]:
    """For functions of batches. A worker process outlives its task, and idle ones count as much of their executor's memory
    as busy ones. So a task begins without what other operators' tasks have kept and ends by giving back what it has freed."""

    def of(each: Callable) -> Callable:
        @functools.wraps(each)
        def run(batches: Iterator) -> Iterator:
            drop_others(operator)
            try:
                yield from each(batches)
            finally:
                give_back()

        return run

    return of


def cut(df: DataFrame) -> DataFrame:
    """df computed once, kept in the shared folder, without its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


#: Bytes inside words where words are what stands between bytes 0x20 and 0x09 to 0x0D.
INSIDE = np.ones(256, bool)
INSIDE[[0x20, *range(0x09, 0x0E)]] = False
LOW_BYTES = np.array([U64((1 << 8 * n) - 1) for n in range(8)] + [U64(2**64 - 1)], U64)


def eights(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as an integer."""
    return np.ndarray((len(raw) - 8,), "<u8", raw.data, 0, (1,))


def equal_slices(a: np.ndarray, a_at: np.ndarray, b: np.ndarray, b_at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether slices of the same size are equal byte for byte; a and b have 9 bytes more than they reach."""
    x, y = eights(a), eights(b)
    ok = (x[a_at] ^ y[b_at]) & LOW_BYTES[np.minimum(size, 8)] == 0
    at, done = np.flatnonzero(ok & (size > 8)), 8
    while len(at):
        same = (x[a_at[at] + done] ^ y[b_at[at] + done]) & LOW_BYTES[np.minimum(size[at] - done, 8)] == 0
        ok[at[~same]] = False
        done += 8
        at = at[same & (size[at] > done)]
    return ok


def slice_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of slices of bytes; raw has 9 bytes more than they reach."""
    eight = eights(raw)
    left = end - start
    with np.errstate(over="ignore"):
        h = left.astype(U64) * GOLDEN
        h = (h ^ (eight[start] & LOW_BYTES[np.minimum(left, 8)])) * U64(0xD6E8FEB86659FD93)
        at, done = np.flatnonzero(left > 8), 8
        while len(at):
            x = h[at]
            x ^= x >> U64(32)
            h[at] = (x ^ (eight[start[at] + done] & LOW_BYTES[np.minimum(left[at] - done, 8)])) * U64(0xD6E8FEB86659FD93)
            done += 8
            at = at[left[at] > done]
    return mix(h)


class Words:
    """The words of many texts at once: hashes, where they stand in `data`, and the first word of each text in `first`.

    first has one entry more than there are texts. No word spans two texts. `fold` maps bytes beforehand.
    """

    def __init__(self, texts: list[bytes], inside: np.ndarray = INSIDE, fold: np.ndarray | None = None):
        self.data = b" ".join(texts)
        n = len(self.data)
        raw = np.zeros(n + 9, np.uint8)
        raw[:n] = np.frombuffer(self.data, np.uint8)
        if fold is not None:
            raw[:n] = fold[raw[:n]]
        on = np.zeros(n + 2, bool)
        on[1:-1] = inside[raw[:n]]
        at = np.cumsum([0, *(len(t) + 1 for t in texts)])
        edges = np.flatnonzero(on[1:] != on[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.start, at)
        self.hash = slice_hashes(raw, self.start, self.end)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """The number of the text in which each of these words stands."""
        return np.searchsorted(self.first, at, "right") - 1


def utf8(texts: pa.Array) -> list[bytes]:
    """Texts as bytes; null counts as empty."""
    return [t or b"" for t in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist()]


def parts(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Ranges of items, each of which ends where it has reached `most` together."""
    out, at, held = [], 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= most or i + 1 == len(sizes):
            out.append((at, i + 1))
            at, held = i + 1, 0
    return out


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes, none if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        h = np.full(n, GOLDEN)
        for i in range(k):
            h = (h ^ words[i : i + n]) * U64(0xD6E8FEB86659FD93)
            h ^= h >> U64(32)
    return mix(h)
