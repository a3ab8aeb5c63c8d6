"""Queries by name, each with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function by its name. Its whole numbers come out as longs."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: longs(f(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def longs(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(column: str) -> F.Column:
    """An array as text."""
    return F.array_join(column, "|").alias(column)


def shared(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A derived table told in SQL that both engines take; its tables stand in braces."""
    import re

    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def plain(sql: str) -> str:
    """The same without braces."""
    return sql.replace("{", "").replace("}", "")
