"""Byte-level BPE encoding and decoding by a segment tree over byte positions.

The tree's leaves are the byte positions of one piece; the leaf of a live token holds the rank of the pair that it
forms with the next live token, and the root tells the leftmost minimum. A merge changes two leaves, its own and that
of its left neighbour, and clears that of the token it swallowed: three point updates of logarithmic cost, so that a
piece of n bytes takes O(n log n) however long it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .common import SLICE, kept, lean

NONE = 1 << 62
#: Characters on which the standard module's classes agree with Unicode's; others take the slower way.
LETTER = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = re.compile(rf"[\t-\r -&(-~{LETTER}]*\Z")
PLAIN_PIECE = re.compile(rf" ?[{LETTER}]+| ?[0-9]+| ?[^\t-\r {LETTER}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: White space as Unicode has it, whatever a library takes \s for.
SPACE = r"\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pieces that a worker keeps; beyond it the older half goes.
KEPT = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: a token in base64 and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def explicit(pattern: str) -> str:
    """The pattern with its white space spelled out."""
    inside = re.sub(r"\[\^\\s", lambda _: f"[^{SPACE}", pattern)
    return inside.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def put(tree: list[int], at: int, value: int) -> None:
    """Sets a node and those above it, as far as their minima change."""
    tree[at] = value
    while at > 1:
        other = tree[at ^ 1]
        if other < value:
            value = other
        at >>= 1
        if tree[at] == value:
            return
        tree[at] = value


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one piece: again and again the leftmost pair of least rank is merged.

    A pair's leaf holds its rank times n, plus its position. Each position but the last has a leaf, and the tree just as
    many leaves: its node 1 is over all of them, whatever their number.
    """
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    if n < 2:
        return [ranks[piece]] if n else []
    get, leaves = ranks.get, n - 1
    tree = [NONE] * leaves
    for i in range(leaves):
        tree.append(NONE if (r := get(piece[i : i + 2])) is None else r * n + i)
    for i in range(leaves - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (top := tree[1]) < NONE:
        i = top % n
        j = after[i]
        k = after[i] = after[j]
        if j < leaves:
            put(tree, leaves + j, NONE)
        if k < n:
            before[k] = i
            r = get(piece[i : after[k]])
            put(tree, leaves + i, NONE if r is None else r * n + i)
        else:
            put(tree, leaves + i, NONE)
        if (h := before[i]) >= 0:
            r = get(piece[h:k])
            put(tree, leaves + h, NONE if r is None else r * n + h)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encodes texts and decodes ids by the ranks of a file; keeps a bounded number of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimal = [str(i) for i in range(len(self.tokens))]
        self.piece = regex.compile(explicit(pattern))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        return (PLAIN_PIECE if PLAIN.match(text) else self.piece).findall(text)

    def ids_of(self, piece: str) -> bytes:
        if (got := self.old.get(piece)) is None:
            got = np.array(merged(piece.encode("utf-8", "surrogatepass"), self.ranks), "<u4").tobytes()
        if len(piece) <= 64:
            if len(self.new) >= KEPT // 2:
                self.old, self.new = self.new, {}
            self.new[piece] = got
        return got

    def encode(self, text: str | None) -> np.ndarray:
        pieces = self.pieces(text or "")
        found = list(map(self.new.get, pieces))
        if None in found:
            found = [self.ids_of(p) if f is None else f for p, f in zip(pieces, found, strict=True)]
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def codec(path: str, pattern: str) -> Codec:
    """One for each worker process and file, until the process works for another operator."""
    codecs = kept("bpe")
    if (path, pattern) not in codecs:
        codecs[path, pattern] = Codec(read_ranks(path), pattern)
    return codecs[path, pattern]


def place(path: str) -> str:
    """Where a vocabulary file is on this machine: its own path, or where Spark put the copy that addFile sent."""
    from os.path import basename, exists

    return path if exists(path) else SparkFiles.get(basename(path))


def add_tokens(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """df with an array of token ids; an empty one for a null or empty text. Other columns stay as they are."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import ArrayType, IntegerType

    @F.arrow_udf(ArrayType(IntegerType()))
    @lean("bpe")
    def encoded(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(place(path), pattern)
        for texts in column:
            yield pa.array([c.encode(t).astype(np.int32) for t in texts.to_pylist()], pa.list_(pa.int32()))

    return df.withColumn(ids, encoded(F.col(text)))


def decoded(path: str, pattern: str) -> Callable[[list[int]], bytes]:
    """A function from ids to bytes."""
    c = codec(place(path), pattern)
    return lambda ids: c.decode(np.asarray(ids, "<u4"))


def digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by spaces) and decoded_sha256, a row for each of df's.

    A null text counts as empty: no ids, and the digests of the empty string.
    """

    @lean("bpe")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(place(path), pattern)
        for batch in batches:
            n, told, back = [], [], []
            for text in batch.column(1):
                ids = c.encode(text.as_py()).tolist()
                n.append(len(ids))
                told.append(hashlib.sha256(" ".join(map(c.decimal.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(c.tokens.__getitem__, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(told), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def round_trip(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and lossless (the ids decode to the text's bytes), a row for each of df's.

    A null text counts as empty.
    """

    @lean("bpe")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(place(path), pattern)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [c.encode(t) for t in texts]
                same = [c.decode(i) == t.encode("utf-8", "surrogatepass") for i, t in zip(ids, texts, strict=True)]
                flat = np.concatenate([*ids, np.empty(0, "<u4")]).astype(np.int32)
                bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(bounds), pa.int64()), lists, pa.array(same)], ["doc_id", "n_tokens", "token_ids", "lossless"])

    return df.select("doc_id", "text").mapInArrow(each, "doc_id long, n_tokens long, token_ids array<int>, lossless boolean")
