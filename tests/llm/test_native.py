import collections
import math
import random
import re

import numpy as np

from siftline.llm import linelog, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


TEXTS = [None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "a " * 40, "x\ny\nx\n \n \nx", "é#*$ %&|<>  😀", "1 2 3 4 5 6 1 2 3 4 5 7 1 2 3 4 5", "\x0b\x0cq\r\nq\r", "a b c d e f g " * 300, "nbsp stays one word"]


def test_counts(spark):
    rng = random.Random(3)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(80)]
    df = spark.createDataFrame([(i, t, "w") for i, t in enumerate(texts)] + [(0, None, "again")], "doc_id long, text string, w string")
    got = [tuple(r)[1:6] for r in rules.judge(df, []).collect()]
    assert got == [brute_counts(t) for t in [*texts, None]]


def test_long_texts(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(50_000)}" for _ in range(100_000)), "\n".join(["one two three four five six"] * 15_000), "x" * 1_000_000, "a " * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:6] for r in rules.judge(df, []).collect()}
    assert [got[i] for i in range(len(texts))] == [brute_counts(t) for t in texts]


def test_base(spark):
    for r in rules.judge(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), []).collect():
        n, _, _, _, again = brute_counts(TEXTS[r.doc_id])
        assert r.base_failed == (n < 10 or 100 * again > 20 * n) and r.kept == (not r.base_failed)


def test_learned_list():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(rules.FEATURES)))
    bad = ((x[:, 2] > 0.8) & (x[:, 5] < 0.5)) | (x[:, 6] > 0.95)
    found = rules.learn(x, bad)
    told = np.zeros(len(x), bool)
    for r in found:
        told |= rules.holds(r, x)
    assert (told == bad).mean() > 0.97
    assert rules.learn(x, np.zeros(3000, bool)) == [] and all(len(r) <= 4 for r in found)


def test_fit_and_verdict(spark):
    good = [(i, " ".join(f"word{(i + j * j) % 97}" for j in range(1, 30))) for i in range(1, 400)]
    bad = [(i, " ".join(f"WORD{(i + j * j) % 89}!!" for j in range(1, 30))) for i in range(400, 600)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 400)) for i in range(1, 600)] + [(None, 1), (5, None), (5, 1)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in rules.judge(docs, rules.fit(docs, labels)).collect()}
    assert all(got[i] for i, _ in good) and not any(got[i] for i, _ in bad)
    assert rules.fit(docs, labels.limit(0)) == [] and rules.fit(docs.limit(0), labels) == []


def brute_lines(docs, min_docs=3, min_tokens=5, depth=4, constant=0.9, similar=0.6):
    lines = []
    for d, text in docs:
        for k, x in enumerate((text or "").split("\n")):
            t = tuple("<*>" if re.search("[0-9]", w) else w for w in WORD.findall(x))
            if text is not None and len(t) >= min_tokens:
                lines.append((d, k, (len(t), t[:depth]), t))
    leaves = collections.defaultdict(lambda: collections.defaultdict(set))
    for d, _, leaf, t in lines:
        leaves[leaf][t].add(d)
    key = {}
    for leaf, own in leaves.items():
        for t in own:
            held = [sum(len(ds) for u, ds in own.items() if u[p] == w) for p, w in enumerate(t)]
            level = sorted(held, reverse=True)[math.ceil(round(similar * len(t), 9)) - 1]
            key[t] = (leaf, tuple(w if level < min_docs or h >= constant * level else "<*>" for w, h in zip(t, held, strict=True)))
    found = collections.defaultdict(set)
    for d, _, _, t in lines:
        found[key[t]].add(d)
    lost = collections.defaultdict(set)
    for d, k, _, t in lines:
        if len(found[key[t]]) >= min_docs and d > min(found[key[t]]):
            lost[d].add(k)
    return {d: None if x is None else "\n".join(v for k, v in enumerate(x.split("\n")) if k not in lost[d]) for d, x in docs}


def test_line_templates(spark, monkeypatch):
    rng = random.Random(5)
    docs = [(0, None), (1, ""), (2, "\n\n"), (3, "page 12 of the whole 40 book"), (4, "page 7 of the whole 9 book\nend"), (5, "own line of its own here\npage 1 of the whole 2 book")]
    for i in range(6, 40):
        x = [f"shared by user u{rng.randrange(9)}{rng.choice('abc')} on this great site today", f"all rights of this site belong to {rng.choice(['ann', 'bob', 'cy'])} and friends", "short one", " ".join(rng.choice("pqrst") for _ in range(7))]
        rng.shuffle(x)
        docs.append((i, "\n".join(x[: rng.randrange(1, 5)])))
    docs.append((99, "x " * 30_000))
    df = spark.createDataFrame([(d, t, 1, "keep") for d, t in docs], "doc_id long, text string, n_lines int, __lost string")
    for few in (100_000, 0):
        monkeypatch.setattr(linelog, "FEW", few)
        got = linelog.clean(df).collect()
        assert {r.doc_id: r.text for r in got} == brute_lines(docs) and len(got) == len(docs)
        assert sum(r.n_dropped for r in got) > 40 and all(r["__lost"] == "keep" for r in got)


def words(rng, n):
    return ["".join(rng.choice("bcdfgaeiou") for _ in range(6)) for _ in range(n)]


def test_templates_of_one_leaf(spark):
    """Two templates that share their length and first four tokens, each with one varying word: all but one line goes."""
    names = words(random.Random(8), 40)
    ways = ["offer of {} ends on friday", "visit to {} begins next week"]
    docs = [(i, "please note that the " + ways[i % 2].format(names[i])) for i in range(40)]
    got = linelog.clean(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(r.n_dropped for r in got) == 38 and all(r.n_dropped == 0 for r in got if r.doc_id < 2)


def planted(rng):
    """Documents of prose with lines of 12 templates, 3 in each of 4 leaves, of 5 to 200 documents, with up to 3 varying
    words of 12; and which lines those are."""
    templates = []
    for leaf in range(4):
        head = words(rng, 4)
        for _ in range(3):
            own = head + words(rng, 4 + 2 * leaf)
            templates.append((own, rng.sample(range(4, len(own)), min(3, int(0.4 * len(own)) - (leaf == 0)))))
    pool, docs, where = words(rng, 300), [], collections.defaultdict(list)
    vary = words(rng, 30)
    for d in range(600):
        x = [" ".join(rng.choice(pool) for _ in range(rng.randrange(5, 15))) for _ in range(rng.randrange(1, 6))]
        for k, (own, fields) in enumerate(templates):
            if rng.random() < (0.01, 0.05, 0.3)[k % 3]:
                t = list(own)
                for f in fields:
                    t[f] = rng.choice(vary)
                x.insert(rng.randrange(len(x) + 1), " ".join(t))
                where[k].append((d, " ".join(t)))
        docs.append((d, "\n".join(x)))
    return docs, where


def test_recall_of_planted_templates(spark):
    docs, where = planted(random.Random(11))
    got = {r.doc_id: r for r in linelog.clean(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    again = [(d, x) for own in where.values() if len(own) >= 3 for d, x in own[1:]]
    caught = sum(x not in got[d].text.split("\n") for d, x in again)
    assert len(again) > 500 and caught >= 0.9 * len(again), caught / len(again)
    assert sum(r.n_dropped for r in got.values()) == caught  # and no line of prose


def test_line_templates_of_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert linelog.clean(df).collect() == []
    odd = spark.createDataFrame([(None, "a b c d e f")] * 4 + [(7, "a b c d e f")] * 2, df.schema)
    assert {r.text for r in linelog.clean(odd).collect()} == {"a b c d e f"}
