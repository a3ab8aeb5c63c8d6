"""From documents to token ids: stages that each take what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers as tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftline.llm import bpe, common, decontam, langid, linelog, neardup
from siftline.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Documents whose language is less likely than this are rejected.
LEAST_LANGUAGE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter or without text go. Rows are judged one by one."""
    into = "_".join(["spoken", *docs.columns])
    own = langid.predict(docs, langid.fit(docs), into)
    return own.where((F.col(into)["lang_pred"] != langid.UNKNOWN) & (F.col(into)["score"] >= LEAST_LANGUAGE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of templates that recur in earlier documents; n_chars follows the text.

    A row for each of docs'. Without doc_id or text, a row stays as it is; rows that share a doc_id are one document."""
    own = linelog.clean(docs, into=tuple("_".join([x, *docs.columns]) for x in ("n_lines", "n_dropped")))
    new = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return own.withColumns(new).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest doc_id.

    Rows without doc_id stay, and so do those whose text is missing or has no word. Rows that share a doc_id stay or go
    together."""
    gone = neardup.groups(docs, percent=80, k=5).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Rows are judged one by one, by their own text: those without text
    stay, and an item without text matches nothing."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids and lossless (whether the ids decode to the text; a null text counts as empty)."""
    return bpe.round_trip(docs, tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("token_ids", token_ids),
]

#: The models and the components of the stages can't be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over what the others keep. Each stage's documents are written below the shared folder and read again,
    so that no stage is computed twice; they go when the next stage's are there. Those before the last stage, which is
    computed when its rows are asked for, stay."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        at = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(at)
        if before:
            common.remove(spark, before)
        docs, before = spark.read.parquet(at), at
    return STAGES[-1][1](spark, docs, sf_dir)
