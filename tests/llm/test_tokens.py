import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from siftline.llm import bpe, tokenfile

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD = ["", " ", "a", "don't you'll 'tis ('s", "x" * 3000, " \n\n  a\t b", "日本語 テスト", "½²³ a²", "a\x1cb\x85c\xa0d", "é́x", "naïve café's", "aaaa bbbb" * 50, "<|endoftext|>", "1 23 4567,89..!!", "\r\n\r\n x", "a  b   c    ", "\n\na", "12\n\n\nb .\t\tc\n d\n\n  e"]


@pytest.fixture(scope="module")
def own():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text("ab' \n\t.é1½'s\x1c\x85", max_size=40))
def test_bpe_like_tiktoken(text):
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}) if not hasattr(test_bpe_like_tiktoken, "own") else test_bpe_like_tiktoken.own
    test_bpe_like_tiktoken.own = own
    c = bpe.codec(RANKS, P.PATTERN)
    ids = c.encode(text)
    assert ids.tolist() == own.encode_ordinary(text)
    assert c.decode(ids) == text.encode()


def test_odd_texts(own):
    c, f, t = bpe.codec(RANKS, P.PATTERN), tokenfile.fast(JSON), Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    for text in ODD:
        assert c.encode(text).tolist() == own.encode_ordinary(text), text
    assert [np.frombuffer(x, "<u4").tolist() for x in f.encode(ODD)] == [t.encode(x, add_special_tokens=False).ids for x in ODD]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab' \n\t.éß1½日'sÀ,", max_size=40), max_size=4))
def test_fast_like_library(texts):
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    assert [np.frombuffer(x, "<u4").tolist() for x in tokenfile.fast(JSON).encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_memory_is_bounded(monkeypatch, own):
    monkeypatch.setattr(bpe, "KEPT", 8)
    monkeypatch.setattr(tokenfile, "KEPT", 8)
    c, f, t = bpe.Codec(bpe.read_ranks(RANKS), P.PATTERN), tokenfile.Fast(JSON), Tokenizer.from_file(JSON)
    for k in range(20):
        text = " ".join(f"word{k}x{j} again" for j in range(9))
        assert c.encode(text).tolist() == own.encode_ordinary(text)
        assert np.frombuffer(f.encode([text])[0], "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(c.new) <= 4 and len(f.keys) <= 8


def rows(spark):
    texts = [*ODD, None, "x " * 200_000, "same", "same"]
    return spark.createDataFrame([(i * 3 % 101, t, "en", "s") for i, t in enumerate(texts)] + [(None, "no id", None, None)], "doc_id long, text string, n_tokens string, ids string")


def test_files_round_trip(spark, tmp_path):
    df = rows(spark)
    at = f"file://{tmp_path}/t"
    got = {r.doc_id: r for r in tokenfile.digests(df, JSON, at).collect()}
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    start = 0
    for r in sorted(df.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id):
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), r.doc_id
        start += len(ids)
    some = {r.doc_id: len(r.ids) // 4 for r in tokenfile.read_tokens(spark, at, [3, 48, 51]).collect()}
    assert some == {i: got[i].n_tokens for i in (3, 48, 51)}


def test_any_reader_and_checksums(spark, tmp_path):
    tokenfile.write_tokens(rows(spark), JSON, f"file://{tmp_path}/t", partitions=2)
    files = sorted((tmp_path / "t").glob("part-*"))
    assert files
    for f in files:
        raw = f.read_bytes()
        assert raw.endswith(tokenfile.MAGIC)
        r = tokenfile.Reader(lambda a, n: raw[a : a + n], len(raw))
        whole = b"".join(ids for _, ids in r)
        assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == whole
        bad = bytearray(raw)
        bad[int(r.at[0]) + 20] ^= 1
        broken = tokenfile.Reader(lambda a, n: bytes(bad[a : a + n]), len(raw))
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(broken)


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfile.digests(df, JSON, f"file://{tmp_path}/t").collect() == []
    assert bpe.digests(df, RANKS, P.PATTERN).collect() == []


def test_digests(spark, own):
    for r, s in zip(bpe.digests(rows(spark), RANKS, P.PATTERN).collect(), rows(spark).collect(), strict=True):
        ids = own.encode_ordinary(s.text or "")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((s.text or "").encode()).hexdigest()


def test_column(spark):
    got = bpe.add_tokens(spark.createDataFrame([("a b", 1), (None, 2)], "text string, token_ids_ int"), RANKS, P.PATTERN).collect()
    assert [bpe.decoded(RANKS, P.PATTERN)(r.token_ids) for r in got] == [b"a b", b""]


def test_chunks_that_share_a_hash(spark, monkeypatch):
    """With a hash of few values, chunks meet others in the memory and in their own part; the ids don't change."""
    monkeypatch.setattr(tokenfile, "slice_hashes", lambda raw, start, end: ((end - start) % 3).astype(np.uint64))
    f, t = tokenfile.Fast(JSON), Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    for texts in (["one two six"], ["ten one", "red dog ran far away", "six"], [*ODD, "two one"], ["ab cd " * 200, "ef"]):
        assert [np.frombuffer(x, "<u4").tolist() for x in f.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_order_of_files():
    names = [f"file:/x/part-{task:05d}-0a-1b-c{k:03d}.txt" for task in (0, 9, 10, 99999, 100000) for k in (0, 999, 1000)]
    assert sorted(names[::-1], key=tokenfile.in_order) == names and sorted(names) != names


def test_many_ranges(spark, tmp_path):
    """Ranges in more than one digit."""
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    texts = {i: f"text {i} " * (i % 17) for i in range(300)}
    df = spark.createDataFrame([(i, x) for i, x in texts.items()], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in tokenfile.digests(df, JSON, f"file://{tmp_path}/t").collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    files = [p.name for p in (tmp_path / "t").glob("part-*")]
    assert len({tokenfile.in_order(f)[0] for f in files}) > 10
    t, start = Tokenizer.from_file(JSON), 0
    for i, x in texts.items():
        n = len(t.encode(x, add_special_tokens=False).ids) + 1
        assert (got[i].start, got[i].n_tokens) == (start, n)
        start += n
