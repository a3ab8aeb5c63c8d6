import collections
import random
import re

import numpy as np
from pyspark.sql import functions as F

from siftline.llm import components, neardup
from siftline.llm.components import roots

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, percent, k=5):
    sets = collections.defaultdict(list)
    for d, t in docs:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[d].append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    own = sorted(d for d in sets if d is not None)
    for i, a in enumerate(own):
        for b in own[:i]:
            if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: (sorted(map(len, s)), None if d is None else find(d)) for d, s in sets.items()}


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    texts = [None, "", "  \n", "one two", "One  TWO", "three", "Én Ñu", "én ñu"]
    base = [word() for _ in range(150)]
    for _ in range(n):  # one large group, whose members differ more and more
        t = list(base)
        for _ in range(rng.randrange(9)):
            t[rng.randrange(len(t))] = word()
        texts.append(" ".join(t))
    texts += [texts[20]] * 5 + [texts[30].upper()] * 3
    for _ in range(40):
        t = [word() for _ in range(rng.randrange(3, 300))]
        texts += [" ".join(t), " ".join(t[: len(t) - rng.randrange(1 + len(t) // 8)])]
    texts.append(" ".join(base * 300))
    docs = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    return docs


def test_like_brute_force(spark):
    docs = corpus()
    for percent in (85, 80):
        want = brute(docs, percent)
        got = neardup.groups(spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n int, id string"), percent).collect()
        assert len(got) == len(docs)
        assert {r.doc_id: ([r.n_shingles], r.component_id) for r in got} == want
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 16)
    docs = corpus(seed=2, n=200)
    got = neardup.groups(spark.createDataFrame(docs, "doc_id long, text string"), 85).collect()
    assert {r.doc_id: ([r.n_shingles], r.component_id) for r in got} == brute(docs, 85)


def test_rows_of_blocks(spark):
    """20,000 members with one stray make a row each, and the stray one for each block; half strays a few each."""
    for strays, most in ((1, 1.1), (10, 1.1), (10_000, 21)):
        members = spark.range(20_000).select(F.lit(5).alias("key"), F.lit(0).alias("band"), "id", F.when(F.col("id") < strays, F.col("id")).otherwise(F.lit(strays)).alias("comp"))
        out = neardup.blocked(members, spark.createDataFrame([(5,)], "key int"))
        assert out.columns == ["i", "j", "mine", "key", "band", "id", "comp"]
        blocks = out.groupBy("i", "j").count().agg(F.sum("count"), F.max("count")).first()
        assert blocks[0] <= most * 20_000 and blocks[1] < 2 * neardup.BLOCK * 1.3, blocks


def test_pairs_of_blocks(spark, monkeypatch):
    """Each pair of members of different components meets in one block, once."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rows = [(k, 0, i, 3 if i % 3 else i) for k, n in ((1, 30), (2, 5), (3, 2)) for i in range(n)]
    out = neardup.blocked(spark.createDataFrame(rows, "key int, band int, id long, comp long"), spark.createDataFrame([(1,), (2,), (3,)], "key int")).collect()
    held = collections.defaultdict(list)
    for r in out:
        held[r.key, r.i, r.j].append(r)
    met = collections.Counter()
    for (key, i, j), own in held.items():
        for a in own:
            for b in own:
                if a.comp != b.comp and (a.id > b.id if i == j else a.mine and not b.mine):
                    met[key, min(a.id, b.id), max(a.id, b.id)] += 1
    assert met == {(k, a, b): 1 for k, _, a, x in rows for l, _, b, y in rows if k == l and a < b and x != y}


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert neardup.groups(spark.createDataFrame([], schema)).collect() == []
    text = "a b c d e f g h"
    got = neardup.groups(spark.createDataFrame([(None, text), (None, None), (4, text), (4, text), (2, text), (3, None)], schema)).collect()
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in got if r.doc_id) == [(2, 2, True), (3, 3, True), (4, 2, False), (4, 2, False)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_registers_and_estimates():
    rng = np.random.default_rng(1)
    off = []
    for j in (0.5, 0.85, 0.95):
        for _ in range(40):
            n = 600
            both = rng.integers(0, 2**63, int(n * 2 * j / (1 + j))).astype(np.uint64)
            a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, n - len(both)).astype(np.uint64)])) for _ in "ab")
            r = neardup.sketch([a, b, np.union1d(a, b)])
            assert (np.maximum(r[0], r[1]) == r[2]).all()  # sketches merge
            off.append(neardup.similarity(r[:1], r[1:2], np.array([len(a)]), np.array([len(b)]))[0] - j)
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.05
    assert (neardup.sketch([np.array([5], np.uint64)])[0] > 0).all() and not neardup.sketch([np.empty(0, np.uint64)]).any()


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(200, 400)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(5, 5)]
    got = {r.node: r.root for r in roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    assert got == {x: find(x) for x in list(root) if find(x) != x}


def least_reached(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {x: find(x) for x in list(root) if find(x) != x}


def odd_edges(seed):
    """A path, one whose ends come before its middle, a hub, repeated and reversed links, loops and random ones."""
    rng = random.Random(seed)
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100 + (i * 37 + 37) % 101) for i in range(101)] + [(1000, i) for i in range(201, 500)]
    edges += [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(350)] + [(5, 5), (-7, 2**62), (2**62, -7)] + [(9000, 9000)]
    edges += edges[:30] + [(v, u) for u, v in edges[30:60]]
    rng.shuffle(edges)
    return edges


def test_components_in_rounds(spark, monkeypatch):
    """Tasks that hold a few links each leave the rest to rounds."""
    monkeypatch.setattr(components, "OWN", 16)
    for seed in (1, 2):
        edges = odd_edges(seed)
        assert {r.node: r.root for r in roots(spark.createDataFrame(edges, "u long, v long")).collect()} == least_reached(edges)
    assert roots(spark.createDataFrame([], "u long, v long")).collect() == []
    assert roots(spark.createDataFrame([(3, 3)], "u long, v long")).collect() == []


def test_forest():
    for seed in range(20):
        edges = odd_edges(seed)
        got = components.forest(*np.array(edges, np.int64).T)
        assert dict(zip(*map(np.ndarray.tolist, got), strict=True)) == least_reached(edges) and len(set(got[0])) == len(got[0])


def test_tasks_of_components(spark):
    """Few links take few tasks, however many partitions they come in: each one that is shuffled leaves files."""
    conf = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, sc, edges = {k: spark.conf.get(k) for k in conf}, spark.sparkContext, odd_edges(3)
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        links = spark.createDataFrame(edges, "u long, v long").repartition(50).localCheckpoint()
        sc.setJobGroup("few links", "")
        got = {r.node: r.root for r in roots(links).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    told = sc.statusTracker()
    stages = {s for j in told.getJobIdsForGroup("few links") for s in told.getJobInfo(j).stageIds}
    tasks = sum(told.getStageInfo(s).numTasks for s in stages if told.getStageInfo(s))
    assert got == least_reached(edges) and tasks <= 4 * 50, tasks
