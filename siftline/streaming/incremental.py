"""The stateless steps on a stream of crawled pages, and first-wins dedup with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.strings import strip
from ..operators.extraction import extracted
from ..schemas import RAW_HTML


def pages(spark: SparkSession, path: str, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW_HTML).option("maxFilesPerTrigger", files_at_once).json(path)


def unique_pages(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """One page for each url within the watermark: the state holds keys of that time only."""
    timed = stream.withColumn("seen_at", F.to_timestamp("fetched_at")).withColumn("url_key", F.lower(strip(F.col("url"))))
    return timed.withWatermark("seen_at", late).dropDuplicatesWithinWatermark(["url_key"]).drop("seen_at", "url_key")


def extract(stream: DataFrame, to: str, checkpoint: str) -> StreamingQuery:
    """Appends page texts to `to`, each file of pages once, whatever is broken off in between."""
    return extracted(stream).writeStream.format("json").option("path", to).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
