"""Quality classifier: ordinal cumulative-link regression on graded ratings, over hashed text.

One weight for each hashed token serves all grades: s is the sum of the weights of a text's distinct tokens, and
P(grade <= k) = logistic(t_k - s) with ordered thresholds t. It gives an expected grade and the probability of the
grade wanted or a better one, by which documents are selected.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[^a-z0-9\x80-\xff\x20\x09-\x0d]+")
#: 0 for toxic, 1 for other bad and 2 for good documents.
GRADE = "CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 2 END"


def hashed(text: str | None) -> np.ndarray:
    """The distinct hashed tokens of a text: its words and runs of signs, A-Z lower-cased, and how varied it is."""
    found = TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
    distinct = set(found)
    varied = b" varied %d" % (10 * len(distinct) // max(1, len(found)))
    size = b" size %d" % len(found).bit_length()
    return np.unique(np.fromiter(map(zlib.crc32, (*distinct, varied, size)), np.int64, len(distinct) + 2) & ((1 << BITS) - 1))


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        return np.array([self.weights[hashed(t)].sum() for t in texts], float)

    def grades(self, s: np.ndarray) -> np.ndarray:
        """The probability of each grade, a row for each score."""
        below = np.hstack([np.zeros((len(s), 1)), logistic(self.thresholds[None, :] - s[:, None]), np.ones((len(s), 1))])
        return np.diff(below, axis=1)


def learn(tokens: list[np.ndarray], grade: np.ndarray, n_grades: int, steps: int = 300, rate: float = 0.05, sparse: float = 2e-4, least: int = 3) -> Model:
    """Proximal Adam on the negative log likelihood with an absolute penalty, so that chance words weigh nothing.

    Tokens in fewer than `least` texts are left out.
    """
    size = 1 << BITS
    row, col = np.repeat(np.arange(len(tokens)), [len(t) for t in tokens]), np.concatenate(tokens)
    in_texts = np.bincount(col, minlength=size)
    own = np.flatnonzero(in_texts >= least)
    place = np.full(size, -1)
    place[own] = np.arange(len(own))
    row, col = row[place[col] >= 0], place[col[place[col] >= 0]]
    n, m = len(tokens), len(own)
    share = np.cumsum(np.bincount(grade, minlength=n_grades)[:-1] + 1) / (n + n_grades)
    t = np.log(share / (1 - share))
    w, m1, m2 = np.zeros(m), np.zeros(m), np.zeros(m)
    tm1, tm2 = np.zeros(n_grades - 1), np.zeros(n_grades - 1)
    lower, upper = grade > 0, grade < n_grades - 1
    for k in range(1, steps + 1):
        s = np.bincount(row, w[col], n) if m else np.zeros(n)
        hi = np.where(upper, logistic(t[np.minimum(grade, n_grades - 2)] - s), 1.0)
        lo = np.where(lower, logistic(t[np.maximum(grade - 1, 0)] - s), 0.0)
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        ds = (dhi - dlo) / n  # of the negative log likelihood by s
        dt = np.zeros(n_grades - 1)
        np.add.at(dt, np.minimum(grade, n_grades - 2), -np.where(upper, dhi, 0) / n)
        np.add.at(dt, np.maximum(grade - 1, 0), np.where(lower, dlo, 0) / n)
        g = np.bincount(col, ds[row], m) if m else np.zeros(0)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        pace = rate / (np.sqrt(m2 / (1 - 0.999**k)) + 1e-4)
        w = w - pace * m1 / (1 - 0.9**k)
        w = np.sign(w) * np.maximum(np.abs(w) - pace * sparse, 0)
        tm1, tm2 = 0.9 * tm1 + 0.1 * dt, 0.999 * tm2 + 0.001 * dt * dt
        t = np.maximum.accumulate(t - rate * (tm1 / (1 - 0.9**k)) / (np.sqrt(tm2 / (1 - 0.999**k)) + 1e-4))
    weights = np.zeros(size, np.float32)
    weights[own] = w
    return Model(weights, t)


def fit(docs: DataFrame, labels: DataFrame, grade: str = GRADE, n_grades: int = 3, sample: int = 8000, most: int = 1 << 27) -> Model:
    """Learns from about `sample` graded documents, chosen by a hash of doc_id; from fewer, where those would be more than
    `most` bytes of text.

    A document with several labels takes the lowest grade; labels without a grade or a document are left out. Without
    any, the model gives all texts the same probabilities.
    """
    graded = labels.select("doc_id", F.expr(grade).cast("int").alias("grade")).where("grade IS NOT NULL").groupBy("doc_id").agg(F.min("grade").alias("grade"))
    hashed_to = lambda part: F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(part * (1 << 20))
    part = min(1.0, sample / max(1, labels.count()))
    held = docs.where(hashed_to(part)).select("doc_id", F.octet_length("text").alias("n")).join(graded.where(hashed_to(part)), "doc_id").agg(F.sum("n")).first()[0] or 0
    share = hashed_to(part * min(1.0, most / max(1, held)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [hashed(t).astype(np.int32) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32()))], ["doc_id", "grade", "tokens"])

    own = docs.where(share).select("doc_id", "text").join(graded.where(share), "doc_id").select("doc_id", "grade", "text")
    rows = sorted(own.mapInArrow(each, "doc_id long, grade int, tokens array<int>").collect(), key=lambda r: (r["doc_id"], r["tokens"]))
    if not rows:
        return Model(np.zeros(1 << BITS, np.float32), np.arange(n_grades - 1, dtype=float))
    return learn([np.array(r["tokens"], np.int64) for r in rows], np.clip([r["grade"] for r in rows], 0, n_grades - 1), n_grades)


def judge(docs: DataFrame, model: Model, wanted: int = 2, least: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_tail (of grade `wanted` or better) and kept (p_tail >= least), a row for each of docs'.

    Rows that share a doc_id or have none are judged one by one; no rows of no rows. A null text counts as empty; it is
    graded by its size and variety, like any other. Texts count to their end; columns other than doc_id and text are
    left out.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.grades(model.score(batch.column(1).to_pylist()))
            tail = p[:, wanted:].sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p @ np.arange(p.shape[1])), pa.array(tail), pa.array(tail >= least)], ["doc_id", "expected_grade", "p_tail", "kept"])

    return docs.select("doc_id", "text").mapInArrow(each, "doc_id long, expected_grade double, p_tail double, kept boolean")
