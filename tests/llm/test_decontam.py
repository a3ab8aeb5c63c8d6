import random

import numpy as np

from siftline.llm import decontam


def brute(a, b):
    """The best local score: a match 1, a mismatch or a gap -1."""
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (1 if x == y else -1), row[j] - 1, new[-1] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment():
    rng = random.Random(1)
    a = [np.array([rng.randrange(4) for _ in range(rng.randrange(1, 20))], np.uint64) for _ in range(300)]
    b = [np.array([rng.randrange(4) for _ in range(rng.randrange(30))], np.uint64) for _ in range(300)]
    assert decontam.align(a, b).tolist() == [brute(x.tolist(), y.tolist()) for x, y in zip(a, b, strict=True)]


def corpus(seed=2):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and", *("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(9))])
    items = [[word() for _ in range(rng.randrange(15, 50))] for _ in range(30)]
    docs, want = [(0, None), (1, ""), (2, "of the and")], {}
    for d in range(10, 400):
        text = [word() for _ in range(rng.randrange(200))]
        if d % 3 == 0:
            i = rng.randrange(30) if d % 2 else 7
            own = list(items[i])
            for _ in range(rng.randrange(1 + len(own) // 8)):  # edits
                k = rng.randrange(len(own))
                own[k : k + 1] = rng.choice([[], [word()], [own[k], word()]])
            at = rng.randrange(len(text) + 1)
            text[at:at] = own
            want[d] = i
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text).title()))
    return docs, [(i, " ".join(x)) for i, x in enumerate(items)] + [(100, None), (101, ""), (102, "a b c")], want


def test_edited_copies(spark, monkeypatch):
    docs, items, want = corpus()
    df = spark.createDataFrame([(d, t, 1.0, "x") for d, t in docs], "doc_id long, text string, score double, item_id string")
    tests = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    for block in (1 << 20, 100):
        monkeypatch.setattr(decontam, "BLOCK", block)
        got = decontam.judge(df, tests).collect()
        assert len(got) == len(docs)
        assert {r.doc_id: r.item_id for r in got if r.contaminated} == want
        assert all(r.kept != r.contaminated and (r.score >= 0.5) == r.contaminated for r in got)
    assert {r.doc_id for r in decontam.clean(df, tests).collect()} == {d for d, _ in docs} - set(want)


def test_no_rows(spark):
    df, tests = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    full = spark.createDataFrame([(1, "a b c d e f"), (None, "a b c d e f")], df.schema)
    assert decontam.judge(df, tests).collect() == [] and decontam.clean(df, tests).collect() == []
    assert [r.kept for r in decontam.judge(full, tests).collect()] == [True, True]
    own = spark.createDataFrame([(5, "a b c d e f")], tests.schema)
    assert [(r.doc_id, r.kept) for r in sorted(decontam.judge(full, own).collect(), key=lambda r: r.doc_id or 0)] == [(None, True), (1, False)]
    assert decontam.clean(full, own).collect() == []


def test_hot_edited_copies(spark):
    """The intact n-grams of a copy that many documents share are seeds, whatever their number."""
    item = [f"w{i}" for i in range(60)]
    edited = [f"x{i}" if i % 6 == 5 else w for i, w in enumerate(item)]  # 50 matches and, before the last of them, 9 mismatches
    part = item[20:52]
    stock = item[:6]  # too few words of the item
    docs = [(i, " ".join([f"a{i}", *edited, "b"])) for i in range(1000)] + [(1000 + i, " ".join([*part, f"c{i}"])) for i in range(30)] + [(2000 + i, " ".join([*stock, f"d{i}"])) for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.score) for r in decontam.judge(df, tests).collect()}
    assert got == {d: (True, 41 / 60) if d < 1000 else (True, 32 / 60) if d < 2000 else (False, 0.0) for d, _ in docs}
    assert {r.doc_id for r in decontam.clean(df, tests).collect()} == {d for d, _ in docs if d >= 2000}


def found(items, docs):
    """What decontam finds of texts, without Spark: (text, item) to score."""
    w = decontam.words([" ".join(x).encode() for x in docs])
    every = decontam.Items.of(list(range(len(items))), [" ".join(x) for x in items], decontam.N)
    seen = np.zeros(len(every.seeds), np.int64)
    at, seed = every.hits(w, decontam.N)
    for s in set(zip(w.text_of(at).tolist(), seed.tolist(), strict=True)):
        seen[s[1]] += 1
    text, item, score = decontam.aligned(every.rare(seen), w, decontam.N, 0.5)
    return {(t, i): x for t, i, x in zip(text.tolist(), item.tolist(), score.tolist(), strict=True) if x >= 0.5}


def test_no_replaced_or_left_out_words_hide_a_copy():
    """All pairs of the bound, by brute force over whole texts, with as many edits as the bound bears."""
    rng = random.Random(5)
    items = [[f"{i}w{rng.randrange(1 + n)}" for _ in range(n)] for i, n in enumerate([9, 12, 16, 24, 33, 40, 57, 60] * 2)]
    docs = []
    for own in items:
        for share in (0.2, 0.25, 0.27):
            for gone in (False, True):
                edited, x = list(own), round(share * len(own))
                for k in [j * len(own) // x for j in range(x)] if rng.random() < 0.7 else rng.sample(range(len(own)), x):
                    edited[k] = None if gone else f"x{rng.randrange(9)}"
                docs.append([*(f"y{rng.randrange(9)}" for _ in range(rng.randrange(30))), *(w for w in edited if w), *(f"z{rng.randrange(9)}" for _ in range(rng.randrange(30)))])
    want = {(t, i): s / len(b) for t, a in enumerate(docs) for i, b in enumerate(items) if (s := brute(b, a)) >= 0.5 * len(b)}
    assert found(items, docs) == want and 30 < len(want) < len(docs)


def test_words_put_in():
    """One after every third word, all behind the first words, and as far apart as the bound bears."""
    item = [f"w{i}" for i in range(60)]
    every_third = [x for i, w in enumerate(item) for x in ([w, f"x{i}"] if i % 3 == 2 else [w])]
    one_gap = [*item[:30], *(f"x{i}" for i in range(29)), *item[30:]]
    two_by_two = [*item[:4], *(x for i in range(4, 60, 2) for x in ([f"x{i}", *item[i : i + 2]]))]
    docs = [every_third, one_gap, two_by_two]
    assert found([item], docs) == {(i, 0): brute(item, x) / 60 for i, x in enumerate(docs)} == {(0, 0): 41 / 60, (1, 0): 31 / 60, (2, 0): 32 / 60}


def test_a_phrase_is_no_item():
    items = [["what", "is", "the", "name", "of", "it"], ["what", "is", "the"], ["what", "is", "the", "name"]]
    docs = [["so", "what", "is", "the", "point"], ["say", "what", "is", "the", "name", "here"]]
    assert found(items, docs) == {(1, 0): 4 / 6, (1, 2): 1.0}
