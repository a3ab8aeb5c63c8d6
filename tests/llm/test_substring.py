import collections
import hashlib
import random
import re

import numpy as np
import pytest

from siftline.llm import substring
from siftline.llm.common import Words, runs
from siftline.llm.fmindex import Bits, Index

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, k=13):
    """For each row the words that stay."""
    least = {}
    rows = [(d, WORD.findall(t or "")) for d, t in docs]
    for d, w in rows:
        for i in range(len(w) - k + 1) if d is not None else ():
            x = tuple(w[i : i + k])
            least[x] = min(least.get(x, d), d)
    out = collections.Counter()
    for d, w in rows:
        gone = set()
        for i in range(len(w) - k + 1) if d is not None else ():
            if least[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 14)))
    pool = [[word() for _ in range(rng.randrange(8, 60))] for _ in range(25)]
    docs = [(0, None), (1, ""), (2, " \n "), (3, "one two"), (4, "x " * 3000), (5, "x " * 40), (6, "a b " * 30), (None, "x " * 50), (None, None)]
    for i in range(10, 180):
        t = []
        for _ in range(rng.randrange(6)):
            t += rng.choice(pool)[rng.randrange(4) :] if rng.random() < 0.5 else [word() for _ in range(rng.randrange(40))]
        docs.append((i * 37 % 1009 + 10, rng.choice([" ", "\n", " \t "]).join(t)))
    common = " ".join(pool[0] + pool[1])
    docs += [(2000 + i, f"{word()} {common} {word()}") for i in range(60)] + [(-5, common[:200]), (2000, common), (2000, common)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize(("seed", "how"), [(1, {}), (2, {"PART": 3000}), (3, {"BLOCK": 100}), (4, {"BLOCK": 1, "SAMPLE": 1, "SHARE": 1e-9, "OFTEN": 1}), (5, {"SAMPLE": 2, "SHARE": 0.02, "OFTEN": 3, "BUCKET": 2000})])
def test_like_brute_force(spark, monkeypatch, seed, how):
    """With small parts, with many blocks a shard, with all minimizers or some told further apart, and with many buckets."""
    for name, value in how.items():
        monkeypatch.setattr(substring, name, value)
    docs = corpus(seed)
    df = spark.createDataFrame([(d, t, 7, b"x") for d, t in docs], "doc_id long, text string, bucket int, packed binary").repartition(5)
    got = collections.Counter(tuple(r) for r in substring.digests(df).collect())
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 1000


def test_hot_minimizer_is_split():
    """Windows around one frequent minimizer go many ways, equal ones together."""
    rng = random.Random(3)
    around = lambda: [f"w{rng.randrange(50)}" for _ in range(12)]
    hashes = runs(Words([f"at the end of e{i}".encode() for i in range(500)]).hash, 5)[::5]
    phrase = f"at the end of e{hashes.argmin()}"  # of 500, the one whose hash is least: windows around it have it as theirs
    p = substring.Passages([" ".join([*around(), phrase, *around()]).encode() for _ in range(2000)], 13)
    keys, n = np.unique(p.key, return_counts=True)
    hot = keys[n > 1000]
    assert len(hot) == 1
    own = np.flatnonzero(p.key == hot[0])
    first, last, key, text = substring.apart(p, own, hot, 13)
    assert np.unique(key, return_counts=True)[1].max() < 20 and len(key) <= 2 * len(own)
    before = {(i, i + 12) for a, b in zip(p.first[own], p.last[own], strict=True) for i in range(a, b - 11)}
    assert sorted(before) == sorted((i, i + 12) for a, b in zip(first, last, strict=True) for i in range(a, b - 11))
    to = {}
    for a, b, k in zip(first, last, key, strict=True):
        for i in range(a, b - 11):
            assert to.setdefault(tuple(p.words.hash[i : i + 13].tolist()), k) == k


def test_spans_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (2, "start " + text + " end"), (3, "w1 w2")], "doc_id long, text string")
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in substring.repeated_spans(df).collect()} == {1: [], 2: [(1, 31)], 3: []}
    assert substring.digests(df.limit(0)).collect() == []


def test_buckets_like_spark(spark):
    ids = [0, 1, -1, 5, 2**62, -(2**63), 12345]
    df = spark.createDataFrame([(i,) for i in ids], "d long").select(substring.bucketed(substring.F.col("d"), 37).alias("b"))
    assert [r.b for r in df.collect()] == substring.bucket_of(np.array(ids), 37).tolist()


def test_index():
    rng = np.random.default_rng(1)
    for k in (13, 5, 4, 3):
        for symbols in (2, 3, 40):
            size = rng.integers(1, 30, 20)
            words = rng.integers(1, symbols + 1, size.sum()).astype(np.uint64) * np.uint64(10**15)
            index = Index(words, size, k)
            first = np.cumsum(size) - size
            places = {}
            for i, (a, n) in enumerate(zip(first.tolist(), size.tolist(), strict=True)):
                for j in range(n - k + 1):
                    places.setdefault(tuple(words[a + j : a + j + k].tolist()), i)
            # Its own passages, and others: parts of them with other words, known and unknown.
            other = np.concatenate((words[::-1], words, rng.integers(1, symbols + 3, 200).astype(np.uint64) * np.uint64(10**15)))
            other[rng.random(len(other)) < 0.02] = 7
            cuts = np.sort(rng.choice(len(other), 30, replace=False))
            for text, at, n in ((words, first, size), (other, cuts[:-1], np.diff(cuts))):
                got = {(w, a): o for w, a, o in zip(*(x.tolist() for x in index.search(text, at, n)), strict=True)}
                want = {(w, j): places[x] for w in range(len(at)) for j in range(n[w] - k + 1) if (x := tuple(text[at[w] + j : at[w] + j + k].tolist())) in places}
                assert got == want


def test_index_is_compressed():
    rng = np.random.default_rng(2)
    size = np.full(20_000, 21)
    words = (rng.zipf(1.3, size.sum()) % 50_000).astype(np.uint64)
    index = Index(words, size, 13)
    assert len(index.symbols) > 10_000 and index.bytes() < 8 * index.n
    assert index.bytes() >= sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))


def test_bits():
    rng = np.random.default_rng(3)
    for n in (1, 63, 64, 65, 1000):
        for p in (0.01, 0.5, 1.0):
            own = rng.random(n) < p
            own[n // 2] = True
            bits = Bits(own)
            assert bits.ones(np.arange(n + 1)).tolist() == [0, *np.cumsum(own).tolist()]
            assert bits.place(np.arange(own.sum())).tolist() == np.flatnonzero(own).tolist()
