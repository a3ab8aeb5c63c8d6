"""Language ID by a byte convolutional network, in numpy.

Bytes are embedded; filters of several widths slide over fixed-length windows; each filter's largest answer in a window
goes through a rectifier to a softmax over the languages. A document's whole text is cut into windows, and its languages'
probabilities are the means over them, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE, lean

WINDOW = 256
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


class Net:
    """Embeds bytes in `size` numbers; `filters` of each width."""

    def __init__(self, langs: list[str], widths: tuple[int, ...] = (2, 3, 4), size: int = 8, filters: int = 16, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.langs, self.widths = langs, widths
        self.p = {"e": rng.normal(0, 0.5, (256, size)), "v": rng.normal(0, 0.3, (len(widths) * filters, len(langs))), "c": np.zeros(len(langs))}
        for w in widths:
            self.p[f"k{w}"] = rng.normal(0, (w * size) ** -0.5, (w, size, filters))
            self.p[f"b{w}"] = np.zeros(filters)
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        self.tables: dict[int, list[np.ndarray]] = {}
        self.fold()

    def fold(self) -> None:
        """For each offset in a filter, what each byte adds to the filter's answer."""
        self.tables = {w: [self.p["e"] @ self.p[f"k{w}"][i] for i in range(w)] for w in self.widths}

    def answers(self, x: np.ndarray, w: int) -> np.ndarray:
        n = x.shape[1] - w + 1
        out = self.tables[w][0].take(x[:, :n], axis=0)
        for i in range(1, w):
            out += self.tables[w][i].take(x[:, i : i + n], axis=0)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each row of bytes; a few rows at a time, so that what is between stays in the cache."""
        out = np.empty((len(x), len(self.langs)), np.float32)
        for at in range(0, len(x), 16):
            own = x[at : at + 16]
            top = [np.maximum(self.answers(own, w).max(axis=1) + self.p[f"b{w}"], 0) for w in self.widths]
            out[at : at + 16] = np.concatenate(top, axis=1) @ self.p["v"] + self.p["c"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        return out / out.sum(axis=1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 32, rate: float = 0.01, seed: int = 5) -> None:
        """Adam on the cross entropy; languages weigh alike."""
        rng = np.random.default_rng(seed)
        weight = len(y) / len(self.langs) / np.maximum(np.bincount(y, minlength=len(self.langs)), 1)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), batch):
                i = order[at : at + batch]
                step += 1
                for k, g in self.gradients(x[i], y[i], weight[y[i]].astype(np.float32)).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
                self.fold()

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        rows, g, pooled, where = np.arange(len(x)), {}, [], []
        for w in self.widths:
            a = self.answers(x, w)
            at = a.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(a, at[:, None], 1)[:, 0] + self.p[f"b{w}"])
        h = np.maximum(np.concatenate(pooled, axis=1), 0)
        z = h @ self.p["v"] + self.p["c"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[rows, y] -= 1
        z *= weight[:, None] / len(x)
        g["v"], g["c"] = h.T @ z + 1e-4 * self.p["v"], z.sum(axis=0)
        back = (z @ self.p["v"].T) * (h > 0)
        g["e"] = np.zeros_like(self.p["e"])
        f = self.p[f"b{self.widths[0]}"].shape[0]
        for j, w in enumerate(self.widths):
            d, at = back[:, j * f : (j + 1) * f], where[j]
            g[f"b{w}"], g[f"k{w}"] = d.sum(axis=0), np.zeros_like(self.p[f"k{w}"])
            for i in range(w):
                table = np.zeros_like(self.tables[w][i])
                np.add.at(table, (x[rows[:, None], at + i], np.arange(f)[None, :]), d)
                g[f"k{w}"][i] = self.p["e"].T @ table
                g["e"] += table @ self.p[f"k{w}"][i].T
        return g


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts, padded with zeros, their numbers of bytes, and each one's text."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    n = np.array([-(-len(r) // WINDOW) for r in raw], np.int64)
    out = np.zeros((int(n.sum()), WINDOW), np.uint8)
    flat, at = out.reshape(-1), 0
    for r, k in zip(raw, n.tolist(), strict=True):
        flat[at : at + len(r)] = np.frombuffer(r, np.uint8)
        at += k * WINDOW
    of = np.repeat(np.arange(len(texts)), n)
    first = np.concatenate(([0], np.cumsum(n)))[:-1]
    size = np.minimum(np.array([len(r) for r in raw])[of] - (np.arange(len(of)) - first[of]) * WINDOW, WINDOW)
    return out, size, of


def spoken(net: Net | None, texts: list[str | None], part: int = 1 << 20) -> tuple[list[str], list[float]]:
    """The language of each text and its probability; `und` and 0 for a null text, one without a letter, or no net."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    own = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if net else []
    sums = np.zeros((len(own), len(net.langs) if net else 0))
    held, total = [], 0

    def score() -> None:
        # A long text comes in parts, so that only part of it is in windows at a time.
        x, size, of = windows([s for _, s in held])
        np.add.at(sums, np.array([k for k, _ in held])[of], net.probabilities(x) * size[:, None])
        held.clear()

    for k, i in enumerate(own):
        for at in range(0, len(texts[i]), part):
            held.append((k, texts[i][at : at + part]))
            total += len(held[-1][1])
            if total >= part:
                score()
                total = 0
    if held:
        score()
    for k, i in enumerate(own):
        best = int(sums[k].argmax())
        langs[i], scores[i] = net.langs[best], float(min(1.0, sums[k, best] / sums[k].sum()))
    return langs, scores


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample: int = 3000, most: int = 256) -> Net | None:
    """Learns from about `sample` windows, as many from each language, of documents that aren't held out.

    docs has doc_id, text and lang. Languages beyond the `most` frequent are not learned. A document gives one window,
    at a place that its doc_id's hash tells. None without any labelled text.
    """
    own = docs.where(F.col("text").rlike("\\p{L}") & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    found = sorted(own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most).collect(), key=lambda r: r["lang"])
    if not found:
        return None
    each = max(1, sample // len(found))
    share = F.create_map(*(F.lit(v) for r in found for v in (r["lang"], int(min(1.0, each / r["count"]) * (1 << 20)))))
    chosen = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.coalesce(share[F.col("lang")], F.lit(0)))
    at = 1 + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - WINDOW, F.lit(1)).cast("long"))
    rows = chosen.select("lang", F.col("text").substr(at.cast("int"), F.lit(WINDOW)).alias("t"), "doc_id").collect()
    rows = sorted((r for r in rows if r["t"]), key=lambda r: (r["doc_id"], r["lang"], r["t"]))[: 2 * sample]
    langs = [r["lang"] for r in found]
    net = Net(langs)
    x, _, of = windows([r["t"] for r in rows])
    first = np.unique(of, return_index=True)[1]
    net.train(x[first], np.array([langs.index(r["lang"]) for r in rows]))
    return net


def predict(docs: DataFrame, net: Net | None, into: str = "spoken") -> DataFrame:
    """docs with a struct (lang_pred, score) in the column `into`; only the text is read for it.

    A row for each of docs', rows that share a doc_id or have none too; no rows of no rows. A text that is null, empty or
    without a letter is `und` with 0; others count to their end, a part at a time. Equal probabilities go to the language
    that comes first by name. A column of docs named `into` is replaced, others stay as they are.
    """

    @F.arrow_udf("lang_pred string, score double")
    @lean("langid")
    def each(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in column:
            langs, scores = [], []
            for at in range(0, len(texts), SLICE):
                for all_, own in zip((langs, scores), spoken(net, texts.slice(at, SLICE).to_pylist()), strict=True):
                    all_ += own
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn(into, each(F.col("text")))
