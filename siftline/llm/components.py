"""Connected components of links, by the forests of what each task holds, then by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lean

#: Links that a task joins at a time.
OWN = 1 << 16


def apart(df: DataFrame, key: str) -> DataFrame:
    """df as it is, but its rows' place by key is forgotten. A join with it deals both sides anew, and only such joins can
    be split by adaptive execution where a key is hot."""
    return df.withColumn(key, F.shiftleft(key, 0))


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the links other than a root, ascending, and its root, the least node that it reaches by them."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        a, b = root[a], root[b]
        on = a != b
        if not on.any():
            break
        a, b = a[on], b[on]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    low = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[low], nodes[root[low]]


def joined(links: DataFrame) -> DataFrame:
    """u and v: links that join the same nodes, of each OWN in a partition the forest. Where there are few links, a few
    partitions hold them, whose number follows from theirs."""

    @lean("components")
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append(tuple(x.to_numpy() for x in batch.columns))
            if sum(len(u) for u, _ in held) >= OWN:
                yield told(held)
                held = []
        if held:
            yield told(held)

    def told(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(*map(np.concatenate, zip(*held, strict=True)))], ["u", "v"])

    return links.coalesce(1 + links.count() // OWN).mapInArrow(each, "u long, v long")


def roots(links: DataFrame, most: int = 64) -> DataFrame:
    """node and root, the smallest node that it reaches, for every node in links (u, v) other than a root itself.

    Each task first joins what it holds of the links, and few links are held by one. What is left goes in rounds. Each
    round hooks every node's greater neighbours to the least of its neighbours, then the lesser ones, until all links end
    at a node that begins none: a few rounds, as paths shrink by a factor in each. Minima are combined before they move,
    and nothing gathers the neighbours of a node in one place.
    """
    e = cut(joined(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")))
    for _ in range(most):
        # Done where every node has one link and no link's end begins another.
        side = e.select(F.col("u").alias("node"), F.lit(1).alias("begins"), F.lit(0).alias("ends")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("begins"), F.lit(1).alias("ends")))
        if side.groupBy("node").agg(F.sum("begins").alias("b"), F.max("ends").alias("e")).where("b > 1 OR (b > 0 AND e > 0)").isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(apart(least, "u"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(least, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        e = cut(joined(cut(small)))
    raise RuntimeError(f"components still change after {most} rounds")
