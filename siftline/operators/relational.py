"""First-wins dedup, ordered distinct, limits, take-while, unions, merges and their counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of the rows of each key, the one that comes first. It is a minimum, combined before rows move."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*(F.col(c) for c in rest)), F.struct(*(F.col(c) for c in order)))
    return df.groupBy(*keys).agg(first.alias("__first")).select(*keys, "__first.*").select(*df.columns)


def ordered_distinct(df: DataFrame, value: str, pos: str) -> DataFrame:
    """Distinct values with the place where each comes first."""
    return df.groupBy(value).agg(F.min(pos).alias(pos))


def first_in_group(df: DataFrame, group: list[str], order: list[str], n: int | None) -> DataFrame:
    """The first n rows of each group; all of them without n (or 0)."""
    if not n:
        return df
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n")


def take_while_filled(pages: DataFrame, group: list[str], page: str, reachable: Column, filled: Column) -> DataFrame:
    """Pages before the first reachable one from the second on that has no items; page 1 always, unreachable ones never."""
    stop = pages.where(reachable & ~filled & (F.col(page) >= 2)).groupBy(*group).agg(F.min(page).alias("__stop"))
    out = pages.where(reachable).join(stop, group, "left") if group else pages.where(reachable).crossJoin(stop.agg(F.min("__stop").alias("__stop")))
    return out.where(F.col("__stop").isNull() | (F.col(page) < F.col("__stop"))).drop("__stop")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merged(old: DataFrame, new: DataFrame, value: str = "domain") -> DataFrame:
    """The distinct union of two lists."""
    return old.select(value).union(new.select(value)).distinct()


def merge_stats(old: DataFrame, new: DataFrame, value: str = "domain") -> DataFrame:
    """before, after and added, from one pass over both lists."""
    both = old.select(value, F.lit(True).alias("old")).union(new.select(value, F.lit(False)))
    each = both.groupBy(value).agg(F.bool_or("old").alias("old"))
    return each.agg(F.count_if("old").alias("before"), F.count(F.lit(1)).alias("after"), F.count_if(~F.col("old")).alias("added"))


def append_if_short(df: DataFrame, more: DataFrame, valid: Column, least: int) -> DataFrame:
    """df, and more below it if fewer than `least` rows of df are valid. The count is a scalar in the plan."""
    short = df.agg((F.count_if(valid) < least).alias("__short"))
    return df.unionByName(more.crossJoin(F.broadcast(short)).where("__short").drop("__short"))


def route(records: DataFrame, label: int) -> DataFrame:
    """Domains of one label; unlabelled ones (-1) belong to no list."""
    return records.where(F.col("label") == label).select("domain").distinct()
