"""Near duplicates by SetSketch: mergeable registers of exponentially spaced truncated minima.

1. Each text becomes the set of its hashed word shingles and a sketch of M registers: the logarithm, to a base close to
   1, of the least of exponential values that the set's elements draw for the register. An element draws its values in
   ascending order and stops at the first that can't lower any register. Sketches merge by the maximum of registers.
2. Texts with one set form a class; the document of the smallest doc_id stands for it.
3. Bands of registers put classes into buckets. In each bucket, all members are paired with one of them, the centre.
4. From two sketches and the sets' sizes, the similarity is estimated jointly by maximum likelihood over how many
   registers are greater, less and equal. Each class is verified on full sets against its likeliest centre, and what
   holds together so far gets one component.
5. Only buckets with several components are looked at again, in blocks: pairs across components whose estimate comes
   near the threshold are compared by their sets' least elements, which for small sets are all, and those that still may
   be linked are verified on full sets. Pairs within a component can't change the result, so that of the bucket's largest
   component only pairs with the members outside it, the strays, count: its members go to as many blocks as there are
   blocks of strays.

Bands are short (ROWS registers), so that a pair at the threshold of 0.8 misses all of them less than once in 10 million
times. The price is that pairs far below it share buckets too; the estimate takes those out.

So a group of copies costs what its members cost, not what its pairs do, unless they fall apart into components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import GOLDEN, U64, Words, cut, lean, mix, parts, runs, utf8
from .components import apart, roots

M, ROWS, BASE, SHIFT = 128, 4, 1.001, 4096
#: Members of a bucket that are compared in one block.
BLOCK = 1024
#: Elements of a set by which pairs of a block are compared.
FINE = 512
#: Bytes of text that are hashed at a time.
PART = 1 << 21


def shingles(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of k consecutive words, A-Z lower-cased; of all words if they are fewer."""
    w = Words([t.lower() for t in texts])
    grams, out = runs(w.hash, k), []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        out.append(np.unique(grams[a : b - k + 1]) if b - a >= k else runs(w.hash[a:b], b - a) if b > a else np.empty(0, U64))
    return out


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """A row of M registers for each set; zeros for an empty one."""
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = np.concatenate([*sets, np.empty(0, U64)])
    low = np.full(len(sets) * M, np.inf)
    with np.errstate(over="ignore", divide="ignore"):
        turn = mix(seed ^ U64(0xA5A5A5A5A5A5A5A5))
        t = np.zeros(len(seed))
        for j in range(M):
            if not len(seed):
                break
            u = mix(seed + U64(j + 1) * GOLDEN)
            t = t - np.log(((u >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (M - j)
            stay = t < low.reshape(-1, M).max(axis=1)[doc]
            if not stay.all():
                seed, turn, doc, t = seed[stay], turn[stay], doc[stay], t[stay]
            # The j-th register of the element's own permutation.
            r = (U64(j) ^ turn) & U64(M - 1)
            for at in (8, 24, 40):
                r = (r * ((turn >> U64(at)) | U64(1)) + (turn >> U64(at + 7))) & U64(M - 1)
                r ^= r >> U64(3)
            np.minimum.at(low, doc * M + r.astype(np.int64), t)
        k = np.floor(SHIFT - np.log(low) / np.log(BASE))
    return np.where(np.isinf(low), 0, np.clip(k, 0, 65535)).astype("<u2").reshape(-1, M)


def similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity of sets of known sizes, from the rows of their registers."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likely(j: np.ndarray) -> np.ndarray:
        x, y = p(u - v * j), p(v - u * j)
        log = lambda z: np.log(np.maximum(z, 1e-300))
        return more * log(x) + less * log(y) + same * log(1 - x - y)

    lo, hi = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(40):  # it is concave in the similarity
        c, d = lo + (hi - lo) * 0.382, lo + (hi - lo) * 0.618
        right = likely(c) < likely(d)
        lo, hi = np.where(right, c, lo), np.where(right, hi, d)
    return (lo + hi) / 2


def margin(threshold: float) -> float:
    """Estimates of pairs at the threshold fall below this less than once in 30,000 times."""
    return threshold - 4 * (threshold * (1 - threshold) / M) ** 0.5


def sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n (size of the set), s1 and s2 (which tell the set) and regs, a row for each of docs'."""

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in parts([len(t) for t in texts], PART):
                held = shingles(texts[a:b], k)
                with np.errstate(over="ignore"):
                    sums = [(int(np.sum(mix(s), dtype=U64)), int(np.sum(mix(s ^ GOLDEN), dtype=U64))) for s in held]
                s1, s2 = np.array(sums, U64).reshape(-1, 2).T.astype(np.int64)
                n = np.array([len(s) for s in held], np.int64)
                regs = pa.array([r.tobytes() if len(s) else None for r, s in zip(sketch(held), held, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(n), pa.array(s1), pa.array(s2), regs], ["doc_id", "n", "s1", "s2", "regs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(each, "doc_id long, n long, s1 long, s2 long, regs binary")


def banded(reps: DataFrame) -> DataFrame:
    """key, band and id: a row for each band of each class."""

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = M // ROWS
        for batch in batches:
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u8").reshape(-1, bands)
            with np.errstate(over="ignore"):
                keys = mix(own + np.arange(1, bands + 1, dtype=U64)[None, :] * GOLDEN).astype(np.int64)
            band = np.broadcast_to(np.arange(bands, dtype=np.int32), keys.shape)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(band.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), bands))], ["key", "band", "id"])

    return reps.select("id", "regs").mapInArrow(each, "key long, band int, id long")


def estimated(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """a, b and estimate of the pairs whose estimate may belong to a link."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where((F.col("na") >= threshold * F.col("nb")) & (F.col("nb") >= threshold * F.col("na")))
    least = margin(threshold)

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ra, rb = (np.frombuffer(b"".join(batch.column(x).to_pylist()), "<u2").reshape(-1, M) for x in ("ra", "rb"))
            j = similarity(ra, rb, batch.column("na").to_numpy(), batch.column("nb").to_numpy())
            ok = pa.array(j >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok), pa.array(j[j >= least])], ["a", "b", "estimate"])

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(each, "a long, b long, estimate double")


def fine(sets: DataFrame) -> DataFrame:
    """id and least: the upper halves of the FINE least elements of each set, and whether those are all."""

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.values.buffers()[1], "<u8", len(x.values), 8 * x.values.offset)[:FINE] >> U64(32) for x in batch.column(1)]
            whole = pa.compute.less_equal(pa.compute.list_value_length(batch.column(1)), FINE)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype("<u4").tobytes() for x in own], pa.binary()), whole], ["id", "least", "whole"])

    return sets.mapInArrow(each, "id long, least binary, whole boolean")


def close(p: np.ndarray, p_whole: bool, others: list[bytes], whole: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the others may be linked with p: similar enough among the elements up to the least bound of the two.

    For whole sets that is their similarity; for others the pairs at the threshold fall short once in 30,000 times.
    Second, which surely are: whole sets that would be with an element less in common, should two halves have met.
    """
    top = 1 << 32
    flat, size = np.frombuffer(b"".join(others), "<u4").astype(np.int64), np.array([len(x) // 4 for x in others])
    row = np.repeat(np.arange(len(others)), size)
    ends = np.cumsum(size) - 1
    bound = np.minimum(np.where(whole, top, flat[ends]), top if p_whole else int(p[-1]))
    inside = flat <= bound[row]
    at = np.minimum(np.searchsorted(p, flat), len(p) - 1)
    common = np.bincount(row[inside & (p[at] == flat)], minlength=len(others))
    union = np.bincount(row[inside], minlength=len(others)) + np.searchsorted(p, bound, "right") - common
    slack = np.where(whole & p_whole, 1e-9, 4 * np.sqrt(threshold * (1 - threshold) / np.maximum(union, 1)))
    return common >= (threshold - slack) * union, whole & p_whole & (common - 1 >= threshold * (union + 1) + 1e-9)


def across(mixed: DataFrame, threshold: float) -> DataFrame:
    """a and b of different components in a bucket whose estimates may belong to a link.

    mixed has key, i, j (the block), band, mine (whether the member is of the first of the block's two sides), id, comp, n,
    regs, least and whole. See blocked for the blocks. They come sorted, so that a task holds one at a time. A pair that
    meets in an earlier band too is left to that.
    """
    least = margin(threshold)

    def block(x: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
        ids, comp, n = (np.array(x[c], np.int64) for c in ("id", "comp", "n"))
        regs = np.frombuffer(b"".join(x["regs"]), "<u2").reshape(-1, M)
        whole, some = np.array(x["whole"]), x["least"]
        band, mine, now = x["band"][0], np.array(x["mine"]), comp.copy()
        alone, every = x["i"][0] == x["j"][0], np.arange(len(ids))
        out: list[tuple[int, int]] = []
        for p in every if alone else np.flatnonzero(mine):
            equal = regs == regs[p]
            # How many equal registers the least estimate can have; the likelihood then decides, then the elements.
            ok = (np.count_nonzero(equal, axis=1) >= (least - 0.1) * M) & (now != now[p]) & (n >= threshold * n[p]) & (n[p] >= threshold * n)
            ok &= every < p if alone else ~mine
            q = np.flatnonzero(ok)
            if band and len(q):
                q = q[~equal[q].reshape(len(q), -1, ROWS)[:, :band].all(axis=2).any(axis=1)]
            if len(q):
                q = q[similarity(regs[q], np.broadcast_to(regs[p], (len(q), M)), n[q], np.full(len(q), n[p])) >= least]
            if len(q):
                may, sure = close(np.frombuffer(some[p], "<u4").astype(np.int64), bool(whole[p]), [some[i] for i in q], whole[q], threshold)
                # Sure links first: what they join needs no other link of this block.
                for i, certain in sorted(zip(q[may].tolist(), sure[may].tolist(), strict=True), key=lambda x: not x[1]):
                    if now[i] != now[p]:
                        out.append((min(ids[i], ids[p]), max(ids[i], ids[p])))
                        if certain:
                            now[now == now[i]] = now[p]
        a, b = np.array(out, np.int64).reshape(-1, 2).T
        return a, b

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        last = None
        for batch in batches:
            rows = batch.to_pydict()
            heads = list(zip(rows["key"], rows["i"], rows["j"], strict=True))
            at = 0
            while at < len(heads):
                end = at
                while end < len(heads) and heads[end] == heads[at]:
                    end += 1
                if heads[at] != last:
                    if held:
                        yield told(*block(held))
                    held, last = {c: [] for c in rows}, heads[at]
                for c in rows:
                    held[c].extend(rows[c][at:end])
                at = end
        if held:
            yield told(*block(held))

    def told(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return mixed.mapInArrow(each, "a long, b long")


def blocked(members: DataFrame, torn: DataFrame) -> DataFrame:
    """The members of torn buckets (key), dealt out to blocks: key, i, j, mine and the columns of members.

    Strays are numbered in blocks from 0, the largest component's members in blocks from -1 downwards. Each block of
    strays meets itself, each other one and each block of the largest component, which never meets itself.
    """
    own = cut(members.join(apart(torn, "key"), "key"))
    sizes = own.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("of"))
    many = lambda n: F.ceil(n / BLOCK).cast("int")
    sizes = sizes.select("key", F.col("top.comp").alias("main"), many(F.col("top.n")).alias("mains"), many(F.col("of") - F.col("top.n")).alias("strays"))
    own = own.join(apart(sizes, "key"), "key").withColumn("stray", F.col("comp") != F.col("main"))
    own = own.withColumn("own", F.pmod(F.xxhash64("id", F.lit(3)), F.when(F.col("stray"), F.col("strays")).otherwise(F.col("mains"))).cast("int"))
    to_main = F.transform(F.sequence(F.lit(1), F.col("mains")), lambda j: F.struct(F.col("own").alias("i"), (-j).alias("j"), F.lit(True).alias("mine")))
    to_strays = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"), (F.col("own") <= o).alias("mine")))
    of_main = F.transform(F.sequence(F.lit(0), F.col("strays") - 1), lambda i: F.struct(i.alias("i"), (-1 - F.col("own")).alias("j"), F.lit(False).alias("mine")))
    return own.withColumn("at", F.explode(F.when(F.col("stray"), F.concat(to_main, to_strays)).otherwise(of_main))).select("at.*", *members.columns)


def set_table(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """id and elements of the documents whose ids are in ids."""

    @lean("neardup")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for a, b in parts([len(t) for t in texts], PART):
                own = [s.view(np.int64) for s in shingles(texts[a:b], k)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(own, pa.list_(pa.int64()))], ["id", "elements"])

    some = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    return some.mapInArrow(each, "id long, elements array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """u and v of the pairs with 100 * intersection >= percent * union on full sets."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("elements").alias(f"e{x}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    n = both.select("a", "b", (F.size("ea") + F.size("eb")).alias("both"), F.size(F.array_intersect("ea", "eb")).alias("common"))
    return n.where(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select(F.col("a").alias("u"), F.col("b").alias("v"))


def groups(docs: DataFrame, percent: int = 80, k: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept, a row for each of docs'.

    Documents link with percent or more of their shingles in common. Without words, or with a null text, a document
    links with nothing. Rows that share a doc_id are one document. A row without doc_id links with nothing, has no
    component and is kept.
    """
    threshold = percent / 100
    own = cut(sketched(docs, k))
    reps = own.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("id"), F.first("regs").alias("regs"))
    reps = cut(reps)
    bands = banded(reps)
    several = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.xxhash64("id", "key").alias("h"), "id")).alias("centre")).where("size > 1")
    members = cut(bands.join(apart(several, "key"), "key").select("key", "band", "id", "size", F.col("centre.id").alias("centre")))
    sets = cut(set_table(docs, members.select("id").distinct(), k))

    star = members.where("id != centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    likely = cut(estimated(star, reps, threshold))
    each = likely.select("a", "b", "estimate", F.col("a").alias("id")).unionByName(likely.select("a", "b", "estimate", F.col("b").alias("id")))
    best = cut(each.groupBy("id").agg(F.max(F.struct("estimate", "a", "b")).alias("x")).select("x.a", "x.b").distinct())
    links = cut(verified(best, sets, percent))
    of = roots(links)

    members = cut(members.join(of.withColumnRenamed("node", "id"), "id", "left").select("key", "band", "id", F.coalesce("root", "id").alias("comp")))
    torn = members.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("key")
    mixed = blocked(members, torn).join(reps.select("id", "n", "regs"), "id").join(fine(sets), "id")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = across(mixed.select("key", "i", "j", "band", "mine", "id", "comp", "n", "regs", "least", "whole").repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j"), threshold)
    rest = cut(found.join(best, ["a", "b"], "left_anti").distinct())
    more = cut(verified(rest, sets, percent))
    if not more.isEmpty():
        of = roots(links.unionByName(more))

    named = reps.join(of.withColumnRenamed("node", "id"), "id", "left").select("n", "s1", "s2", F.coalesce("root", "id").alias("component_id"))
    # Rows that share a doc_id but not a text may have several components; roots join them only through links.
    out = own.join(named, ["n", "s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
