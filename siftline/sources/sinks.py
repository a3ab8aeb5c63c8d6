"""Writers. What replaces a file is staged beside it and swapped in, so that nothing reads what is being overwritten."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import exists, records


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def write_domains(df: DataFrame, path: str, fold_case: bool = False) -> None:
    """One text file of the sorted domains, in place of what was there; by lower case or by code points."""
    key = F.lower("domain") if fold_case else F.col("domain")
    replace(df.select("domain").orderBy(key).coalesce(1), path)


def replace(df: DataFrame, path: str, backup: bool = False) -> None:
    """Writes a text column to the file `path` through a staging folder; the old file goes, or stays as .bak.

    The old file is only renamed before the new one is in its place, so that whatever breaks off in between, it is there:
    under its own name, or as .bak or .old."""
    spark = df.sparkSession
    stage = f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.text(stage)
    fs, at = _fs(spark, path)
    part = next(s.getPath() for s in fs.listStatus(_path(spark, stage)) if s.getPath().getName().startswith("part-"))
    held = _path(spark, f"{path}.{'bak' if backup else 'old'}")
    if fs.exists(at):
        fs.delete(held, False)
        fs.rename(at, held)
    if not fs.rename(part, at):
        raise OSError(f"{path} couldn't be put in place; what was there is {held.toString()}")
    if not backup:
        fs.delete(held, False)
    fs.delete(_path(spark, stage), True)


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines with nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_records(df: DataFrame, path: str) -> None:
    """Adds files of JSON lines; what is there stays, also if the job is broken off."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_raw(df: DataFrame, path: str, raw: str = "raw") -> None:
    """The records' own lines as they were read, unknown fields included."""
    df.select(F.col(raw).alias("value")).write.mode("overwrite").text(path)


def write_by_source(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("source").json(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).coalesce(1).write.mode("overwrite").csv(path, header=True)


def repair_records(spark: SparkSession, path: str, schema: str, fix: dict) -> DataFrame:
    """The lines of a JSONL file after a repair: malformed ones as they are, others with the columns of `fix` replaced."""
    own = records(spark, path, schema, keep_malformed=True)
    names = [c for c in own.columns if c not in ("file", "line_no", "raw", "malformed")]
    fixed = own.withColumns(fix)
    line = F.when(F.col("malformed"), F.col("raw")).otherwise(F.to_json(F.struct(*dict.fromkeys([*names, *fix])), {"ignoreNullFields": "false"}))
    return fixed.select("line_no", line.alias("value"))


def workspace(spark: SparkSession, root: str, folders: tuple[str, ...] = ("raw", "features", "reports")) -> list[str]:
    """Makes the folders that aren't there."""
    out = []
    for f in folders:
        fs, at = _fs(spark, f"{root.rstrip('/')}/{f}")
        if not fs.exists(at):
            fs.mkdirs(at)
            out.append(str(at))
    return out


def report(title: str, lines: list[str], now: datetime) -> str:
    """A report in Markdown: a title, the time in UTC, and a bullet for each line."""
    return "\n".join([f"# {title}", "", f"Generated: {now.isoformat(timespec='seconds')}", "", *(f"- {x}" for x in lines), ""])


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(content))
    out.close()


def write_report(spark: SparkSession, path: str, title: str, lines: list[str], now: datetime) -> None:
    write_bytes(spark, path, report(title, lines, now).encode())


__all__ = [n for n in dir() if n.startswith(("write_", "append_", "repair_")) or n in ("replace", "report", "workspace", "exists")]
