import gc
import os
import weakref
from types import SimpleNamespace

import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from siftline.llm import bpe, neardup

from .test_native import brute_lines
from .test_neardup import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_stages(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, docs, SF)
        if k < 4:
            assert df.columns == docs.columns and df.dtypes == docs.dtypes
        df.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append({r.doc_id: r for r in docs.collect()})
    language, lines, unique, free, ids = kept
    assert {d: r.text for d, r in lines.items()} == brute_lines([(d, r.text) for d, r in language.items()])
    assert all(r.n_chars == len(r.text) for r in lines.values())
    groups = brute([(d, r.text) for d, r in lines.items()], 80)
    assert set(unique) == {d for d in lines if groups[d][1] == d}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = {d for d, r in unique.items() if any(i in r.text for i in items)}
    assert found and not found & set(free) and len(free) > 0.9 * (len(unique) - len(found))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    assert {d: r.token_ids for d, r in ids.items()} == {d: own.encode_ordinary(r.text) for d, r in free.items()}
    assert all(r.lossless and r.n_tokens == len(r.token_ids) for r in ids.values())


def test_odd_documents(spark):
    rows = [(None, None, None, None, None, "x"), (1, None, "en", "s", 0, "x"), (2, "", None, None, None, "x"), (3, "a b c d e f g h i", "en", "s", 17, "x"), (3, "a b c d e f g h i", "en", "s", 17, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_lines string")
    tests = spark.createDataFrame([(1, "t u v w x y z")], "item_id long, text string")
    for docs in (df, df.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, SF)
            assert docs.dtypes == df.dtypes
        docs = corpus_pipeline.decontam.clean(docs, tests)
        corpus_pipeline.token_ids(spark, docs, SF).collect()


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
def test_no_stage_is_computed_twice(spark, monkeypatch):
    """Each document passes through each stage once; the rows are those of the stages one by one."""
    count = {name: spark.sparkContext.accumulator(0) for name, _ in corpus_pipeline.STAGES[:3]}

    def counting(name, stage):
        def each(batches):
            for b in batches:
                count[name].add(b.num_rows)
                yield b

        return lambda spark, docs, sf: stage(spark, docs, sf).mapInArrow(each, docs.schema)

    stages = [(n, counting(n, f) if n in count else f) for n, f in corpus_pipeline.STAGES]
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    got = corpus_pipeline.run(spark, SF)
    n = got.count()
    assert 0 < n <= count["near_duplicates"].value <= count["lines"].value == count["language"].value <= spark.read.parquet(f"{SF}/documents.parquet").count()


def test_workers_keep_no_other_stages_memory(spark):
    """A worker process lives on from stage to stage: the tokenizer that it keeps for its next task goes once it works for
    another stage."""
    task = SimpleNamespace(select=lambda *columns: SimpleNamespace(mapInArrow=lambda each, schema: each))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(600)), "text": [None, "a b c d e f"] * 300})
    ids, sketches = corpus_pipeline.token_ids(spark, task, SF), neardup.sketched(task, 5)
    assert sum(map(len, ids(iter([batch])))) == 600
    kept = weakref.ref(bpe.codec(P.path("byte_bpe_50k.tiktoken"), P.PATTERN))
    list(ids(iter([batch])))
    gc.collect()
    assert kept() is not None
    assert sum(map(len, sketches(iter([batch])))) == 600
    gc.collect()
    assert kept() is None
